"""Observation tables over the order, event, embedding and document tables.

The same SQL text runs in Spark and in the reference engine of the checks. The
narrow variants read only what a report needs: a score report over orders never
opens ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepline.catalog import Catalog

MODEL = "ord_f"
LABEL = "ord_f_target_ind"

ORDER_OBS = """
SELECT o.o_orderkey AS obs_id,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period_dt,
       CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS ord_f_target_ind,
       0 AS ord_f_score_ind,
       o.o_totalprice AS total_price,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE c.c_acctbal END AS acctbal,
       l.sum_qty AS sum_qty,
       l.max_price AS max_price,
       CASE WHEN o.o_orderkey % 1000 <> 0 THEN NULL ELSE o.o_totalprice END AS mostly_missing,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 3 ELSE 0 END + o.o_orderkey % 5 AS DOUBLE) AS planted,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(substr(o.o_orderpriority, 1, 1) AS INT) END AS prio_rank,
       l.n_lines AS n_lines,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_mktsegment END AS segment,
       CASE WHEN o.o_orderkey % 500 = 1 THEN concat('RARE_', CAST(o.o_orderkey % 7 AS VARCHAR(3))) ELSE n.n_name END AS nation,
       concat('C', CAST(o.o_custkey AS VARCHAR(20))) AS cust_code,
       CASE WHEN o.o_orderkey % 19 = 0 THEN NULL WHEN c.c_acctbal >= 2000 THEN 'Y' ELSE 'N' END AS rich_flag,
       CAST(CAST(floor(o.o_totalprice / 100) AS BIGINT) + (o.o_orderkey * 7919) % 5000 AS DOUBLE) / CAST(10000 AS DOUBLE) AS p1
FROM {orders} o
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, max(l_extendedprice) AS max_price,
                  CAST(count(*) AS INT) AS n_lines FROM {lineitem} GROUP BY l_orderkey) l
  ON l.l_orderkey = o.o_orderkey
"""

SCORED_ORDERS = """
SELECT o_orderkey AS obs_id,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS period_dt,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS ord_f_target_ind,
       CAST(CAST(floor(o_totalprice / 100) AS BIGINT) + (o_orderkey * 7919) % 5000 AS DOUBLE) / CAST(10000 AS DOUBLE) AS p1
FROM {orders}
"""

EVENT_OBS = """
SELECT event_id AS obs_id,
       CAST(ts AS DATE) AS period_dt,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS ev_target_ind,
       value AS value,
       concat('U', CAST(user_id AS VARCHAR(20))) AS user_code,
       CAST((event_id * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS p1
FROM {events}
"""

# Reference rows for the order table: every customer casts one vote per column,
# a quarter of them against the role and a third against the level.
ORDER_ALIASES = (
    ("obs_id", "ID", "INTERVAL"), ("period_dt", "PERIOD", "INTERVAL"),
    ("total_price", "INPUT", "INTERVAL"), ("acctbal", "INPUT", "INTERVAL"),
    ("sum_qty", "INPUT", "INTERVAL"), ("max_price", "INPUT", "INTERVAL"),
    ("mostly_missing", "INPUT", "INTERVAL"), ("planted", "INPUT", "INTERVAL"),
    ("prio_rank", "INPUT", "ORDINAL"), ("n_lines", "INPUT", "ORDINAL"),
    ("segment", "INPUT", "NOMINAL"), ("nation", "INPUT", "NOMINAL"),
    ("cust_code", "INPUT", "NOMINAL"), ("rich_flag", "INPUT", "BINARY"),
    ("p1", "SCORE", "INTERVAL"),
)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _run(spark: SparkSession, folder: str, text: str, *tables: str) -> DataFrame:
    return spark.sql(text, **{t: spark.read.parquet(f"{folder}/{t}.parquet") for t in tables})


def order_obs(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, ORDER_OBS, "orders", "customer", "nation", "lineitem")


def scored_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, SCORED_ORDERS, "orders")


def event_obs(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, EVENT_OBS, "events")


def order_reference(spark: SparkSession, folder: str) -> DataFrame:
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    aliases = F.array(*[
        F.struct(F.lit(a).alias("alias"), F.lit(r).alias("role"), F.lit(v).alias("level"))
        for a, r, v in ORDER_ALIASES
    ])
    return customer.select("c_custkey", F.explode(aliases).alias("a")).select(
        F.col("a.alias").alias("ALIAS_NM"),
        F.when(F.col("c_custkey") % 4 == 0, "REJECTED").otherwise(F.col("a.role")).alias("ROLE_NM"),
        F.when(F.col("c_custkey") % 3 == 0, "ORDINAL").otherwise(F.col("a.level")).alias("LEVEL_NM"),
    )


def order_catalog() -> Catalog:
    """What ``assign_roles`` finds for the order table."""
    rows = {a: (a, r, v) for a, r, v in ORDER_ALIASES}
    rows[LABEL] = (LABEL, "TARGET", "BINARY")
    rows["ord_f_score_ind"] = ("ord_f_score_ind", "REJECTED", "BINARY")
    order = ["obs_id", "period_dt", LABEL, "ord_f_score_ind", *[a for a, _, _ in ORDER_ALIASES[2:]]]
    return Catalog.of(rows[n] for n in order)


def marked_obs(spark: SparkSession, folder: str) -> DataFrame:
    """The order table with two more columns: a mark that too few rows carry for a tree to use, and a copy of the price."""
    mark = F.when(F.col("obs_id") % 5000 == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return order_obs(spark, folder).withColumns({"rare_mark": mark, "price_copy": F.col("total_price") * 2 + 1})


def marked_catalog() -> Catalog:
    more = [("rare_mark", "INPUT", "INTERVAL"), ("price_copy", "INPUT", "INTERVAL")]
    return Catalog.of([(v.name, v.role, v.level) for v in order_catalog().variables] + more)


def wide_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """``embeddings`` with one interval column per dimension of the longest vector."""
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    width = df.agg(F.max(F.size("embedding"))).first()[0] or 0
    dims = [df["embedding"][i].cast("double").alias(f"e{i}") for i in range(width)]
    return df.select("vec_id", *dims, (df["label"] == 0).cast("int").alias("emb_target_ind"))
