"""Reading observation tables and keeping stages, parameters and models."""

from __future__ import annotations

import datetime
import decimal
import os
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "csv", "orc", "json")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None,
               schema: str | None = None, **options) -> DataFrame:
    """An observation table from files; ``columns`` reach the scan."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known: {FORMATS}")
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", True))
    if schema:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    return df.select(*columns) if columns else df


def jdbc_options(url: str, query: str | None = None, table: str | None = None, *, column: str | None = None,
                 lower: int | None = None, upper: int | None = None, partitions: int | None = None,
                 user_env: str = "DB_USER", password_env: str = "DB_PASSWORD", driver: str | None = None) -> dict[str, str]:
    """Options of a JDBC read. Credentials come from the environment, never from code.

    A table is read in ``partitions`` ranges of ``column``; a query is pushed down whole.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {"url": url}
    if query is not None:
        options["query"] = query
    else:
        options["dbtable"] = table
        if column is not None:
            options |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                        "numPartitions": str(partitions)}
    if driver:
        options["driver"] = driver
    for name, variable in (("user", user_env), ("password", password_env)):
        if variable in os.environ:
            options[name] = os.environ[variable]
    return options


def database_options(query: str | None, jdbc: dict[str, str]) -> dict[str, str]:
    """Options of one read: a table in ranges as it is, or a query pushed down whole."""
    if "dbtable" in jdbc:
        if query is not None:
            raise ValueError("a table is read without a query")
        return jdbc
    if query is None and "query" not in jdbc:
        raise ValueError("give a query or a table")
    return jdbc | ({"query": query} if query is not None else {})


def sql_literal(value) -> str:
    """A value as any database reads it."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(keys: DataFrame, column: str, parts: int, tie: str | None = None) -> list[str]:
    """Predicates that together hold every row once, as many rows in each as the values of ``column`` allow.

    Cuts are quantiles of the keys, so a skewed key gives narrow ranges where rows are many. Missing keys
    are a part of their own. A value that fills several parts is one; with ``tie``, a column of whole numbers, it is
    divided by their remainders. ``keys`` holds the columns and is read once.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    accuracy = max(10_000, 4 * parts)
    probabilities = [i / parts for i in range(1, parts)] or [0.5]
    row = keys.agg(F.percentile_approx(column, probabilities, accuracy).alias("cuts"), F.max(column).alias("top")).first()
    empty = f"{column} IS NULL"
    if row["top"] is None:
        return [empty]
    cuts = Counter(row["cuts"]) if parts > 1 else Counter()
    edges, out, low = sorted(cuts), [], None
    for cut in edges:  # rows below a cut, and the cut itself where it fills parts
        heavy = cuts[cut] > 1
        low_side = [] if low is None else [f"{column} {'>' if low[1] else '>='} {sql_literal(low[0])}"]
        out.append(" AND ".join([*low_side, f"{column} < {sql_literal(cut)}"]))
        if heavy:
            same = f"{column} = {sql_literal(cut)}"
            n = cuts[cut]
            # a remainder of a negative number is negative, so both signs are named
            out += [same] if tie is None else [f"{same} AND abs(mod({tie}, {n})) = {i}" for i in range(n)] + [f"{same} AND {tie} IS NULL"]
        low = (cut, heavy)
    if low is None:
        return [f"{column} IS NOT NULL", empty]
    return [*out, f"{column} {'>' if low[1] else '>='} {sql_literal(low[0])}", empty]


def read_in_ranges(spark: SparkSession, jdbc: dict[str, str], column: str, parts: int, tie: str | None = None) -> DataFrame:
    """A table or a pushed-down query of a database, one task a predicate; nobody needs to know the bounds.

    The keys are read first: the column alone, in even ranges between its extremes when it is a number.
    """
    source = jdbc["dbtable"] if "dbtable" in jdbc else f"({jdbc['query']}) q"
    rest = {k: v for k, v in jdbc.items() if k not in ("url", "dbtable", "query", "partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    wanted = ", ".join([column, *([tie] if tie else [])])
    read = lambda table, **more: spark.read.jdbc(jdbc["url"], table, properties=rest, **more)
    ends = read(f"(SELECT min({column}) AS a, max({column}) AS b FROM {source}) e").first()
    ranges = {}
    if isinstance(ends["a"], (int, decimal.Decimal)) and ends["a"] < ends["b"]:
        ranges = {"column": column, "lowerBound": int(ends["a"]), "upperBound": int(ends["b"]) + 1, "numPartitions": parts}
    keys = read(f"(SELECT {wanted} FROM {source}) k", **ranges)
    return read(source, predicates=range_predicates(keys, column, parts, tie))


def extract(spark: SparkSession, query: str | None = None, jdbc: dict[str, str] | None = None, **views: DataFrame) -> DataFrame:
    """A table by query: from a database with ``jdbc`` options, else over the given frames.

    With the options of a table and a column, ``jdbc_options(table=..., column=...)``, the
    database is read in ranges, one task each.
    """
    if jdbc is not None:
        return spark.read.format("jdbc").options(**database_options(query, jdbc)).load()
    return spark.sql(query, **views)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


@dataclass(frozen=True)
class StageStore:
    """Named snapshots between stages: tables as parquet, fitted state as one line of JSON."""

    spark: SparkSession
    folder: str

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write and read back, which also ends the lineage."""
        df.write.mode("overwrite").parquet(self._path(name))
        return self.load(name)

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def save_state(self, name: str, model) -> None:
        """The model's JSON; tables that belong to it go beside it as parquet."""
        tables = model.tables() if hasattr(model, "tables") else {}
        for part, table in tables.items():
            table.write.mode("overwrite").parquet(self._path(f"{name}.{part}"))
        row = self.spark.createDataFrame([(type(model).__name__, model.to_json(), sorted(tables))],
                                         "kind string, state string, tables array<string>")
        row.coalesce(1).write.mode("overwrite").json(self._path(name))

    def load_state(self, name: str, cls):
        row = self.spark.read.schema("kind string, state string, tables array<string>").json(self._path(name)).first()
        if row["kind"] != cls.__name__:
            raise ValueError(f"{name} holds a {row['kind']}, not a {cls.__name__}")
        parts = row["tables"] or []
        if not parts:
            return cls.from_json(row["state"])
        return cls.from_json(row["state"], {part: self.load(f"{name}.{part}") for part in parts})

    def save_model(self, name: str, model) -> None:
        model.write().overwrite().save(self._path(name))

    def load_model(self, name: str, cls):
        return cls.load(self._path(name))


