"""Document fingerprints by consistent weighted sampling.

A document is a weighted set: its words with their counts. For every register the
word and a register number seed two gamma(2, 1) variates r, c and a uniform b.
With t = floor(ln(weight) / r + b), the word's key is ln c - r (t - b) - r and the
register keeps the (word, t) of the smallest key. Two documents agree in a register
with the probability sum(min) / sum(max) of their weights.

The key and 16 bits of a hash of (word, t) share one integer: a register is
``min`` of a bigint and everything stays in generated code. Counting
words and taking minima use the partitioning of the documents: words never move.
A document and its edited text are sampled together, once for a word they share; the
digest of the edited text rides along as numbers in a row of its own, so texts are
moved once and the first halves that a neighbour needs once more.

Cases: a missing text is an empty one; texts without words have an empty
fingerprint, like each other and unlike all others; rows equal in key and text are
one document for *the next document*, and each of them is returned; rows that
share a key only follow each other in the order of a hash of the text; a missing
key comes last; a single document is its own next one; an empty table gives an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import GAP, discard, stored, whole
from prepline.operators.rank import rank_rows

REGISTERS = 40
AT_ONCE = 8  # registers taken from a row at once
_HEX = 4  # digits of a register in the fingerprint
_MARK = 4 * _HEX  # bits of a register
_KEY_SCALE, _KEY_SHIFT = float(1 << 32), 128.0
_NONE = 1 << 62  # above every key: the word is not in the text
_DIGITS = 13  # of a digest in one bigint
KEY = ["__i", "__k"]


def _uniform(bits: Column, at: int) -> Column:
    """21 of 64 bits as a uniform in (0, 1)."""
    return (F.shiftrightunsigned(bits, at).bitwiseAND(F.lit((1 << 21) - 1)) + F.lit(0.5)) * F.lit(1.0 / (1 << 21))


def samples(word: Column, register: Column, log_weights: list[Column]) -> list[Column]:
    """For each weight of a word one integer: scaled key above, hash of (word, t) below."""
    x, y = F.xxhash64(word, register), F.xxhash64(word, register, F.lit(1))
    r = -F.ln(_uniform(x, 0) * _uniform(x, 21))
    ln_c = F.ln(-F.ln(_uniform(x, 42) * _uniform(y, 0)))
    b = _uniform(y, 21)
    out = []
    for log_weight in log_weights:
        t = F.floor(log_weight / r + b)
        key = ln_c - r * (t - b + F.lit(1.0))  # well inside (-128, 128)
        scaled = ((key + F.lit(_KEY_SHIFT)) * F.lit(_KEY_SCALE)).cast("bigint")
        mark = F.shiftrightunsigned(y, 45).bitwiseXOR(t).bitwiseAND(F.lit((1 << _MARK) - 1))
        out.append(F.shiftleft(scaled, _MARK).bitwiseOR(mark))
    return out


def signatures(texts: DataFrame, names: list[str], registers: int = REGISTERS, carried: dict[str, Column] | None = None) -> DataFrame:
    """``KEY``, a fingerprint ``__f<i>`` for each of the named text columns, and carried whole numbers.

    Without carried numbers, documents that have no words in any text have no row.

    ``texts`` has one row a document and should be partitioned by its keys.
    """
    carried = carried or {}
    versions = F.explode(F.array(*[F.struct(F.lit(i).alias("v"), F.col(n).alias("t")) for i, n in enumerate(names)])).alias("__p")
    each = texts.select(*KEY, F.array(*carried.values()).cast("array<bigint>").alias("__c"), versions)
    # Missing words open the first text; their rows carry the numbers in place of a count.
    opening = F.when(F.col("__p.v") == 0, F.array_repeat(F.lit(None).cast("string"), len(carried))).otherwise(F.array().cast("array<string>"))
    words = each.select(*KEY, "__c", F.col("__p.v").alias("__v"), F.posexplode(F.concat(opening, F.split(F.col("__p.t"), GAP))).alias("__at", "__w"))
    words = words.filter(F.col("__w").isNull() | (F.col("__w") != ""))
    opens = F.col("__w").isNull()
    count = lambda i: (F.col("__v") == i).cast("bigint")
    first = F.when(opens, F.col("__c")[F.col("__at")]).otherwise(count(0))
    rows = words.select(*KEY, F.when(opens, F.col("__at")).otherwise(F.lit(-1)).alias("__o"), F.xxhash64("__w").alias("__w"),
                        first.alias("__n0"), *[F.when(opens, F.lit(0)).otherwise(count(i)).alias(f"__n{i}") for i in range(1, len(names))])
    counted = rows.groupBy(*KEY, "__o", "__w").agg(*[F.sum(f"__n{i}").alias(f"__n{i}") for i in range(len(names))])
    absent = [F.when((F.col(f"__n{i}") == 0) | (F.col("__o") >= 0), F.lit(_NONE)).otherwise(F.lit(0)).alias(f"__a{i}") for i in range(len(names))]
    logs = [F.ln(F.greatest(F.col(f"__n{i}"), F.lit(1)).cast("double")).alias(f"__ln{i}") for i in range(len(names))]
    numbers = [F.when(F.col("__o") == k, F.col("__n0")).alias(n) for k, n in enumerate(carried)]
    weighted = counted.select(*KEY, *numbers, "__w", *absent, *logs)
    # a few registers at a time: the code for a row must stay small enough to be compiled
    groups = -(-registers // AT_ONCE)
    turned = weighted.withColumn("__g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    least = []
    for j in range(min(AT_ONCE, registers)):
        drawn = samples(F.col("__w"), F.col("__g") * F.lit(AT_ONCE) + F.lit(j), [F.col(f"__ln{i}") for i in range(len(names))])
        least += [F.min(d + F.col(f"__a{i}")).alias(f"__r{i}_{j}") for i, d in enumerate(drawn)]
    found = turned.groupBy(*KEY, "__g").agg(*[F.max(n).alias(n) for n in carried], *least)

    def part_of(i: int) -> Column:
        parts = [F.lpad(F.lower(F.hex(F.col(f"__r{i}_{j}").bitwiseAND(F.lit((1 << _MARK) - 1)))), _HEX, "0") for j in range(min(AT_ONCE, registers))]
        return F.when(F.col(f"__r{i}_0") >= _NONE, "").otherwise(F.concat(*parts)).alias(f"__f{i}")

    parts = found.select(*KEY, "__g", *carried, *[part_of(i) for i in range(len(names))])
    whole_print = lambda i: F.concat(*[F.max(F.when(F.col("__g") == g, F.col(f"__f{i}"))) for g in range(groups)])
    return parts.groupBy(*KEY).agg(*[F.max(n).alias(n) for n in carried], *[F.substring(whole_print(i), 1, registers * _HEX).alias(f"__f{i}") for i in range(len(names))])


def likeness(a: Column, b: Column, registers: int = REGISTERS) -> Column:
    """Share of registers in which two fingerprints agree."""
    same = [F.when(F.substring(a, j * _HEX + 1, _HEX) == F.substring(b, j * _HEX + 1, _HEX), 1.0).otherwise(0.0) for j in range(registers)]
    total = same[0]
    for one in same[1:]:
        total = total + one
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(total / F.lit(float(registers)))


def digest_numbers(text: Column) -> dict[str, Column]:
    """The SHA-256 of a text as whole numbers, which combine without sorting."""
    sha = F.sha2(text.cast("binary"), 256)
    return {f"__d{i}": F.conv(F.substring(sha, i * _DIGITS + 1, _DIGITS), 16, 10).cast("bigint") for i in range(-(-64 // _DIGITS))}


def digest_text() -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(f"__d{i}")), min(_DIGITS, 64 - i * _DIGITS), "0") for i in range(-(-64 // _DIGITS))])


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Two hashes, of the key and of the text, that name a document, with its key and text."""
    body = whole(text)
    return docs.select(F.xxhash64(F.lit(3), F.col(doc_id)).alias("__i"), F.xxhash64(body, F.col(doc_id).isNull()).alias("__k"),
                       F.col(doc_id).alias("__id"), body.alias("__text"))


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", registers: int = REGISTERS) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row."""
    rows = keyed(docs, doc_id, text)
    one = rows.groupBy(*KEY).agg(F.first("__text").alias("__text"))
    found = signatures(one, ["__text"], registers)
    own = F.coalesce("__f0", F.lit(""))  # texts without words have no row
    return rows.select(*KEY, "__id").join(found, KEY, "left").select(F.col("__id").alias(doc_id), own.alias("fingerprint"))


def successors(rows: DataFrame) -> DataFrame:
    """Each document with its length and the one after it in ascending key order; the last is followed by the first."""
    ids = rows.select(*KEY, "__id", F.char_length("__text").alias("__chars")).distinct()
    ids = ids.withColumn("__order", -F.col("__id").cast("double"))
    ranked = stored(rank_rows(ids, "__order", ["__id", "__k"], rank="__rank"), "ranked")
    last = F.broadcast(ranked.agg(F.max("__rank").alias("__last")))
    after = ranked.crossJoin(last).select(  # one row on the right
        F.when(F.col("__rank") == 1, F.col("__last")).otherwise(F.col("__rank") - 1).alias("__rank"),
        F.col("__i").alias("__next_i"), F.col("__k").alias("__next_k"))
    out = stored(ranked.join(after, "__rank").select(*KEY, "__chars", "__next_i", "__next_k"), "successors")
    discard(ranked)
    return out


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", registers: int = REGISTERS) -> DataFrame:
    """Every row with fingerprints of its text and of the edited text, whose last half is the head of the next document."""
    rows = keyed(docs, doc_id, text)
    nexts = successors(rows)
    one = rows.groupBy(*KEY).agg(F.first("__text").alias("__text"))
    half = F.floor(F.col("__chars") / 2).cast("int")
    wanted = nexts.select(F.col("__next_i").alias("__i"), F.col("__next_k").alias("__k"), F.col("__i").alias("__to_i"), F.col("__k").alias("__to_k"), "__chars")
    heads = one.join(wanted, KEY).select(
        F.col("__to_i").alias("__i"), F.col("__to_k").alias("__k"), "__chars", F.substring(F.col("__text"), F.lit(1), half).alias("__head"))
    kept = F.substring(F.col("__text"), F.lit(1), F.col("__chars") - half)
    both = one.join(heads, KEY).select(*KEY, "__chars", "__text", F.concat(kept, F.col("__head")).alias("__edited"))
    carried = {"__n": F.col("__chars").cast("bigint"), **digest_numbers(F.col("__edited"))}
    prints = stored(signatures(both, ["__text", "__edited"], registers, carried), "fingerprints")

    after = prints.select(F.col("__i").alias("__next_i"), F.col("__k").alias("__next_k"), F.col("__f0").alias("__f2")).join(
        nexts.drop("__chars"), ["__next_i", "__next_k"]).select(*KEY, "__f2")
    wide = prints.join(after, KEY)
    return rows.select(*KEY, "__id").join(wide, KEY).select(
        F.col("__id").alias(doc_id), F.col("__n").alias("n_chars"), digest_text().alias("edited_sha256"),
        F.col("__f0").alias("fingerprint"), F.col("__f1").alias("edited_fingerprint"),
        likeness(F.col("__f0"), F.col("__f1"), registers).alias("near_edited"),
        likeness(F.col("__f0"), F.col("__f2"), registers).alias("near_next"))
