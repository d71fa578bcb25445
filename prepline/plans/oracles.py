"""The same results stated in plain SQL, for checking.

Written from the definitions, with global windows and nested queries, so that
nothing is shared with the way the operators work.
"""

from __future__ import annotations

from prepline.operators.lift import DECILES
from prepline.operators.quantiles import KNOTS
from prepline.plans.observations import (
    EVENT_OBS, LABEL, ORDER_ALIASES, ORDER_OBS, SCORED_ORDERS, TABLES, marked_catalog, order_catalog,
)
from prepline.plans.queries import BINARIES, BINNED, CORRELATED, EXTRACT, INTERVALS, LIFT_DEPTHS, NOMINALS, ORDINALS, WEIGHTS

_T = {t: t for t in TABLES}
ORDERS = ORDER_OBS.format(**_T)
SCORED = SCORED_ORDERS.format(**_T)
EVENTS = EVENT_OBS.format(**_T)


def dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)" if isinstance(x, float) else f"CAST({x} AS DOUBLE)"


def uniform(salt: str, key: str = "obs_id") -> str:
    text = f"concat_ws('|', '12345', '{salt}', CAST({key} AS VARCHAR))"
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def r6(x: str) -> str:
    return f"round({x}, 6) + 0.0"


SPLIT = uniform("split")
OBS = f"WITH obs AS ({ORDERS})"
HALVES = (f"{OBS}, train AS (SELECT * FROM obs WHERE {SPLIT} < {dbl(0.4)}),"
          f" test AS (SELECT * FROM obs WHERE {SPLIT} >= {dbl(0.4)})")
SC = f"WITH s AS ({SCORED})"


def values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(repr(v) if not isinstance(v, float) else dbl(v) for v in row) + ")" for row in rows) + ")"


def unpivot(table: str, columns, cast: str, name: str = "level") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS var, CAST({c} AS {cast}) AS {name} FROM {table}" for c in columns)


def profile(table: str, columns) -> str:
    return f"SELECT var, level, count(*) AS n FROM ({unpivot(table, columns, 'VARCHAR')}) GROUP BY var, level"


def mode(table: str, column: str) -> str:
    return (f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"
            f" ORDER BY count(*) DESC, {column} LIMIT 1)")


# --- imputation -------------------------------------------------------------------


def knots(table: str, columns) -> str:
    ps = "[" + ", ".join(repr(p) for p in KNOTS) + "]"
    return "SELECT " + ", ".join(f"quantile_cont({c}, {ps}) AS k_{c}" for c in columns) + f" FROM {table}"


def drawn(column: str, literal: bool = False) -> str:
    u1, u2 = uniform(f"{column}:1"), uniform(f"{column}:2")
    limits = [f"k_{column}[{i + 1}]" if literal else dbl(KNOTS[i]) for i in range(1, 14)]
    seg = "(1 + " + " + ".join(f"CAST({u1} > {v} AS INT)" for v in limits) + ")"
    return (f"coalesce({column}, k_{column}[{seg}] + (k_{column}[{seg} + 1] - k_{column}[{seg}]) * {u2})")


def imputed(fit: str, apply: str, intervals, ordinals=(), nominals=(), binaries=(), literal=False,
            keep="obs_id", rounded=True, extra="") -> str:
    def shown(c):
        return r6(drawn(c, literal)) if rounded else drawn(c, literal)

    parts = [keep]
    parts += [f"{shown(c)} AS IMP_{c}" for c in intervals]
    parts += [f"coalesce({c}, 0) AS IMP_{c}" for c in ordinals]
    parts += [f"coalesce({c}, 'Missing') AS IMP_{c}" for c in nominals]
    parts += [f"coalesce({c}, {mode(fit, c)}) AS IMP_{c}" for c in binaries]
    source = f"{apply}, ({knots(fit, intervals)}) AS k" if intervals else apply
    return f"SELECT {', '.join(parts)}{extra} FROM {source}"


FIVE = [c for c in INTERVALS if c != "mostly_missing"]
TWO_NOMINAL = ["segment", "nation"]
ALL_INPUTS = dict(intervals=FIVE, ordinals=ORDINALS, nominals=TWO_NOMINAL, binaries=BINARIES)


def impute_params() -> str:
    k = f"k AS ({knots('train', FIVE)})"
    parts = [
        f"SELECT '{c}' AS var, 'INTERVAL' AS kind, CAST(NULL AS VARCHAR) AS fill, CAST(i AS INT) AS pos,"
        f" {r6(f'k_{c}[i + 1]')} AS knot FROM k, range(0, 15) t(i)" for c in FIVE
    ]
    single = "CAST(NULL AS INT) AS pos, CAST(NULL AS DOUBLE) AS knot"
    parts += [f"SELECT '{c}', 'ORDINAL', '0', {single}" for c in ORDINALS]
    parts += [f"SELECT '{c}', 'NOMINAL', 'Missing', {single}" for c in TWO_NOMINAL]
    parts += [f"SELECT '{c}', 'BINARY', {mode('train', c)}, {single}" for c in BINARIES]
    return f"{HALVES}, {k} " + " UNION ALL ".join(parts)


# --- levels -----------------------------------------------------------------------


def rare(table: str, columns, share: float = 0.001) -> str:
    shares = f"SELECT *, n / CAST(sum(n) OVER (PARTITION BY var) AS DOUBLE) AS share FROM ({profile(table, columns)})"
    low = f"SELECT *, count(*) OVER (PARTITION BY var) AS n_rare FROM ({shares}) WHERE share < {dbl(share)}"
    return f"SELECT var, level, n, share FROM ({low}) WHERE n_rare >= 2"


def pooled(column: str, rare_table: str = "rare") -> str:
    """The pooled value of a column, given the table of rare levels."""
    hit = f"EXISTS (SELECT 1 FROM {rare_table} r WHERE r.var = '{column}' AND r.level IS NOT DISTINCT FROM {column})"
    return f"CASE WHEN {hit} THEN '_OTHER_' ELSE {column} END"


def replaced(fit: str, column: str) -> str:
    seen = f"EXISTS (SELECT 1 FROM {fit} f WHERE f.{column} IS NOT DISTINCT FROM x.{column})"
    return f"CASE WHEN {seen} THEN x.{column} ELSE {mode(fit, column)} END"


def replacement(apply: str) -> str:
    cols = ", ".join(f"{replaced('train', c)} AS REP_{c}" for c in NOMINALS)
    return f"{HALVES} SELECT x.obs_id, {cols} FROM {apply} x"


# --- binning ----------------------------------------------------------------------


def _h(a: str, b: str) -> str:
    def part(c):
        return f"CASE WHEN {c} > 0 THEN -({c} / CAST({a} + {b} AS DOUBLE)) * log2({c} / CAST({a} + {b} AS DOUBLE)) ELSE 0 END"

    return f"({part(a)} + {part(b)})"


def running(table: str, columns) -> str:
    """CTEs ``hist`` and ``run``: class counts per value, and up to each value."""
    rows = " UNION ALL ".join(f"SELECT '{c}' AS var, CAST({c} AS DOUBLE) AS value, {LABEL} AS y FROM {table}" for c in columns)
    w = "OVER (PARTITION BY var ORDER BY value)"
    return (
        f"hist AS (SELECT var, value, CAST(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS BIGINT) AS n0,"
        f" CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n1 FROM ({rows}) WHERE value IS NOT NULL GROUP BY var, value),"
        f" run AS (SELECT var, value, lead(value) {w} AS nxt, CAST(sum(n0) {w} AS BIGINT) AS c0, CAST(sum(n1) {w} AS BIGINT) AS c1 FROM hist)"
    )


def mdl_rounds(rounds: int = 6) -> str:
    """CTEs ``seg0, best0, seg1, ...`` and ``cuts(var, cut)``: the recursion, written out."""
    out = ["seg0 AS (SELECT var, CAST('-infinity' AS DOUBLE) AS low, max(value) AS high, CAST(0 AS BIGINT) AS p0,"
           " CAST(0 AS BIGINT) AS p1, max(c0) AS t0, max(c1) AS t1 FROM run GROUP BY var)"]
    for i in range(rounds):
        gain = (f"round({_h('t0', 't1')} - ((a0 + a1) / CAST(t0 + t1 AS DOUBLE)) * {_h('a0', 'a1')}"
                f" - ((b0 + b1) / CAST(t0 + t1 AS DOUBLE)) * {_h('b0', 'b1')}, 12)")
        out.append(
            f"cand{i} AS (SELECT g.*, r.value, r.nxt, c0 - p0 AS a0, c1 - p1 AS a1, t0 - (c0 - p0) AS b0, t1 - (c1 - p1) AS b1"
            f" FROM seg{i} g JOIN run r ON r.var = g.var AND r.value > g.low AND r.nxt <= g.high WHERE t0 > 0 AND t1 > 0)")
        out.append(f"gain{i} AS (SELECT *, {gain} AS gain FROM cand{i})")
        out.append(f"best{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY var, low, high ORDER BY gain DESC, value) AS rn"
                   f" FROM gain{i}) WHERE rn = 1)")
        k = "(CAST(t0 > 0 AS INT) + CAST(t1 > 0 AS INT))"
        k1 = "(CAST(a0 > 0 AS INT) + CAST(a1 > 0 AS INT))"
        k2 = "(CAST(b0 > 0 AS INT) + CAST(b1 > 0 AS INT))"
        bound = (f"(log2(CAST(t0 + t1 - 1 AS DOUBLE)) + log2(pow(3, {k}) - 2) - ({k} * {_h('t0', 't1')}"
                 f" - {k1} * {_h('a0', 'a1')} - {k2} * {_h('b0', 'b1')})) / CAST(t0 + t1 AS DOUBLE)")
        out.append(f"take{i} AS (SELECT * FROM best{i} WHERE gain > {bound})")
        out.append(
            f"seg{i + 1} AS (SELECT var, low, value AS high, p0, p1, a0 AS t0, a1 AS t1 FROM take{i} UNION ALL"
            f" SELECT var, value AS low, high, p0 + a0, p1 + a1, b0, b1 FROM take{i})")
    union = " UNION ALL ".join(f"SELECT var, (value + nxt) / 2 AS cut FROM take{i}" for i in range(rounds))
    out.append(f"cuts AS ({union})")
    return ", ".join(out)


# --- ranks, lift, gain --------------------------------------------------------------


def ranked(source: str, label: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return (f"SELECT *, row_number() OVER ({part} ORDER BY p1 DESC, obs_id) AS rk,"
            f" count(*) OVER ({part}) AS n, sum({label}) OVER ({part}) AS p,"
            f" sum({label}) OVER ({part} ORDER BY p1 DESC, obs_id ROWS UNBOUNDED PRECEDING) AS cum FROM ({source})")


def hits(source: str, label: str, depths, by: str = "") -> str:
    head = f"{by}, " if by else ""
    group = f"GROUP BY {head}depth"
    return (
        f"SELECT {head}depth, max(n) AS n, CAST(max(p) AS BIGINT) AS n_pos,"
        f" CAST(sum(CASE WHEN rk <= ceil(n * depth) THEN {label} ELSE 0 END) AS BIGINT) AS hits"
        f" FROM ({ranked(source, label, by)}), {values([(float(d),) for d in depths])} AS d(depth) {group}"
    )


STRIDE = "(SELECT {0} FROM (SELECT {0}, row_number() OVER (ORDER BY {0}) AS rn FROM (SELECT DISTINCT {0} FROM {1})) WHERE (rn - 1) % 2 = 0)"


def every_second(source: str, period: str = "period_dt") -> str:
    return f"SELECT * FROM ({source}) WHERE {period} IN " + STRIDE.format(period, f"({source})")


def midpoints(source: str, label: str, by: str = "") -> str:
    """``(by, k, a, n, p)``: the plateau middles in units of 1 / 2n, from 0 to 2n."""
    head = f"{by}, " if by else ""
    curve = f"SELECT {head}rk, CAST(cum AS BIGINT) AS cum, n, CAST(p AS BIGINT) AS p FROM ({ranked(source, label, by)})"
    plateaus = (f"SELECT {head}cum AS k, min(rk) AS first, max(rk) AS last, max(n) AS n, max(p) AS p FROM ({curve})"
                f" WHERE cum > 0 GROUP BY {head}cum")
    inner = f"SELECT {head}k, CASE WHEN k = p THEN 2 * n ELSE first + last END AS a, n, p FROM ({plateaus})"
    first = f"SELECT DISTINCT {head}CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS a, n, p FROM ({curve}) WHERE p > 0"
    return f"{first} UNION ALL {inner}"


def curve_grid(source: str, label: str, by: str = "") -> str:
    head = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    lines = f"SELECT *, lead(a) OVER ({part} ORDER BY k) AS b FROM ({midpoints(source, label, by)})"
    inside = "2 * n * g >= 100 * a AND (2 * n * g < 100 * b OR (g = 100 AND b = 2 * n))"
    share = "((2 * n * g) / CAST(100 AS DOUBLE) - a) / (b - a)"
    return (f"SELECT {head}CAST(g AS INT) AS step, g / CAST(100 AS DOUBLE) AS x, (k + {share}) / p AS y"
            f" FROM ({lines}), range(0, 101) t(g) WHERE b IS NOT NULL AND {inside}")


LIFT = "hits / nullif(n_pos * depth, 0)"

# --- thresholds ---------------------------------------------------------------------

GRID = f"g AS (SELECT CAST(i AS INT) AS j, {dbl(0.7)} + {dbl(0.3)} * i / 999 AS threshold FROM range(0, 1000) t(i))"
SWEEP = f"""{SC}, {GRID},
sweep AS (SELECT j, threshold,
  CAST(sum(CASE WHEN {LABEL} = 1 AND 1 - p1 < threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN {LABEL} = 0 AND 1 - p1 < threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN {LABEL} = 1 AND NOT (1 - p1 < threshold) THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN {LABEL} = 0 AND NOT (1 - p1 < threshold) THEN 1 ELSE 0 END) AS BIGINT) AS tn
FROM s, g GROUP BY j, threshold)"""
PRECISION, RECALL = "(tp / nullif(CAST(tp + fp AS DOUBLE), 0))", "(tp / nullif(CAST(tp + fn AS DOUBLE), 0))"


def fbeta(beta: int) -> str:
    return (f"coalesce({1 + beta**2} * {PRECISION} * {RECALL} / nullif({beta**2} * {PRECISION} + {RECALL}, 0), 0)")


KAPPA = """((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE)
  - (CAST(tp + fp AS DOUBLE) * (tp + fn) + CAST(fn + tn AS DOUBLE) * (fp + tn)) / pow(CAST(tp + fp + fn + tn AS DOUBLE), 2))
  / nullif(1 - (CAST(tp + fp AS DOUBLE) * (tp + fn) + CAST(fn + tn AS DOUBLE) * (fp + tn)) / pow(CAST(tp + fp + fn + tn AS DOUBLE), 2), 0)"""

GAPPY = (f"SELECT * REPLACE (CASE WHEN obs_id % 5 = 0 OR obs_id % 7 = 0 THEN NULL ELSE p1 END AS p1) FROM ({SCORED})")
SWEEP_MISSING = SWEEP.replace(SCORED, GAPPY).replace("1 - p1 < threshold", "coalesce(1 - p1 < threshold, false)")
LABELLED = f"{SC}, l AS (SELECT {LABEL} AS y, CASE WHEN 1 - p1 < {dbl(0.75)} THEN 1 ELSE 0 END AS z FROM s)"


def report() -> str:
    def per_class(c: int) -> str:
        return (f"SELECT '{c}' AS r, count(*) FILTER (y = {c} AND z = {c}) / CAST(nullif(count(*) FILTER (z = {c}), 0) AS DOUBLE) AS pr,"
                f" count(*) FILTER (y = {c} AND z = {c}) / CAST(nullif(count(*) FILTER (y = {c}), 0) AS DOUBLE) AS re,"
                f" count(*) FILTER (y = {c}) AS su FROM l")

    classes = (f"c AS (SELECT r, coalesce(pr, 0) AS pr, coalesce(re, 0) AS re, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f, su"
               f" FROM ({per_class(0)} UNION ALL {per_class(1)}))")
    acc = "(SELECT count(*) FILTER (y = z) / CAST(count(*) AS DOUBLE) FROM l)"
    return f"""{LABELLED}, {classes}
SELECT r AS "row", {r6('pr')} AS precision, {r6('re')} AS recall, {r6('f')} AS f1, CAST(su AS BIGINT) AS support FROM c
UNION ALL SELECT 'accuracy', {r6(acc)}, {r6(acc)}, {r6(acc)}, (SELECT count(*) FROM l)
UNION ALL SELECT 'macro avg', {r6('avg(pr)')}, {r6('avg(re)')}, {r6('avg(f)')}, CAST(sum(su) AS BIGINT) FROM c
UNION ALL SELECT 'weighted avg', {r6('sum(pr * su) / sum(su)')}, {r6('sum(re * su) / sum(su)')}, {r6('sum(f * su) / sum(su)')}, CAST(sum(su) AS BIGINT) FROM c"""


# --- search -------------------------------------------------------------------------

_OTHER = "(CAST((obs_id * 31) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE))"
_BLENDS = " UNION ALL ".join(
    f"SELECT {i} AS setting, obs_id, {LABEL}, {dbl(w)} * p1 + {dbl(1 - w)} * {_OTHER} AS p1 FROM s" for i, w in enumerate(WEIGHTS))
BLEND_SCORES = f"""{SC}, scores AS (SELECT CAST(setting AS INT) AS setting, {LIFT} AS score FROM ({hits(_BLENDS, LABEL, [0.1], 'setting')}))"""

# --- scaling ------------------------------------------------------------------------


def ranged(c: str, fit: str = "train") -> str:
    low, high = f"(SELECT min({c}) FROM {fit})", f"(SELECT max({c}) FROM {fit})"
    return f"-1 + ({c} - {low}) / coalesce(nullif(CAST({high} - {low} AS DOUBLE), 0), 1) * 2"


def zscored(c: str, fit: str = "train") -> str:
    return f"({c} - (SELECT avg({c}) FROM {fit})) / coalesce(nullif((SELECT stddev_pop({c}) FROM {fit}), 0), 1)"


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NATIONS = sorted([*(f"NATION_{i}" for i in range(25)), *(f"RARE_{i}" for i in range(7))])


def dummy_columns(column: str, levels) -> str:
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS \"{column}_{v}\"" for v in levels[1:])


FLAG = "CASE WHEN rich_flag = 'Y' THEN 1 WHEN rich_flag = 'N' THEN 0 END AS rich_flag"


# --- the whole preparation ------------------------------------------------------------


def prepared(apply: str) -> str:
    base = dict(ALL_INPUTS, rounded=False)
    fit_train = imputed("train", "train", **base)
    fit_apply = imputed("train", apply, **base)
    names = [f"IMP_{c}" for c in (*FIVE, *ORDINALS, *BINARIES)]
    shown = ", ".join(f"{r6('x.' + n)} AS {n}" if n[4:] in FIVE else f"x.{n}" for n in names)
    return f"""{HALVES}, it AS ({fit_train}), ia AS ({fit_apply}), rare AS ({rare('it', ['IMP_nation', 'IMP_segment'])}),
gt AS (SELECT *, {pooled('IMP_nation')} AS BIN_IMP_nation FROM it),
ga AS (SELECT *, {pooled('IMP_nation')} AS BIN_IMP_nation FROM ia)
SELECT x.obs_id, {shown}, {replaced('gt', 'BIN_IMP_nation')} AS REP_BIN_IMP_nation,
  {replaced('gt', 'IMP_segment')} AS REP_IMP_segment FROM ga x"""


def _imputed_names(columns) -> str:
    return values([(f"IMP_{c}",) for c in columns]) + " AS c(var)"


def _prepared_catalog() -> str:
    """The variables after the whole preparation, with the step that rejected each."""
    raw = {v.name: v for v in marked_catalog().variables}
    rows = [(n, "REJECTED" if v.role == "INPUT" else v.role, v.level, "") for n, v in raw.items()]
    forest, clusters = "IMP_rare_mark", "IMP_price_copy"
    for n in (*FIVE, "rare_mark", "price_copy", *ORDINALS, *TWO_NOMINAL, *BINARIES):
        name = f"IMP_{n}"
        by = "forest" if name == forest else "clusters" if name == clusters else ""
        rows.append((name, "REJECTED" if by or n in TWO_NOMINAL else "INPUT", raw[n].level, by))
    rows += [("BIN_IMP_nation", "REJECTED", "NOMINAL", ""), ("REP_BIN_IMP_nation", "INPUT", "NOMINAL", ""), ("REP_IMP_segment", "INPUT", "NOMINAL", "")]
    return f"SELECT name, role, level, nullif(step, '') AS rejected_by FROM {values(rows)} AS v(name, role, level, step)"


def _catalog_after(rejected_case: str) -> str:
    rows = [(v.name, v.role, v.level) for v in order_catalog().variables]
    return f"SELECT name, CASE WHEN {rejected_case} THEN 'REJECTED' ELSE role END AS role, level FROM {values(rows)} AS v(name, role, level)"


def set_role() -> str:
    names = [v.name for v in order_catalog().variables]
    votes = f"""votes AS (SELECT a.alias, CASE WHEN c.c_custkey % 4 = 0 THEN 'REJECTED' ELSE a.role END AS role_nm,
  CASE WHEN c.c_custkey % 3 = 0 THEN 'ORDINAL' ELSE a.level END AS level_nm
  FROM customer c, {values(ORDER_ALIASES)} AS a(alias, role, level))"""

    def top(col: str) -> str:
        return (f"SELECT alias, {col} FROM (SELECT alias, {col}, row_number() OVER (PARTITION BY alias ORDER BY count(*) DESC, {col}) AS rn"
                f" FROM votes GROUP BY alias, {col}) WHERE rn = 1")

    return f"""WITH {votes}
SELECT n.name, CASE WHEN n.name IN ('ord_f_build_ind', 'ord_f_score_ind') THEN 'REJECTED'
  WHEN n.name = 'ord_f_target_ind' THEN 'TARGET' ELSE r.role_nm END AS role,
  CASE WHEN n.name IN ('ord_f_build_ind', 'ord_f_score_ind', 'ord_f_target_ind') THEN 'BINARY' ELSE l.level_nm END AS level,
  CAST(n.pos AS INT) AS pos
FROM {values([(i, n) for i, n in enumerate(names)])} AS n(pos, name)
LEFT JOIN ({top('role_nm')}) r ON r.alias = n.name LEFT JOIN ({top('level_nm')}) l ON l.alias = n.name"""


def _importance() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS var, round(coalesce(CASE WHEN stddev_pop({c}) = 0 THEN 0 ELSE abs(corr(CAST({c} AS DOUBLE), {LABEL})) END, 0), 6) AS importance FROM obs"
        for c in CORRELATED)
    return f"{OBS}, imp AS ({parts})"


def levels_union(table: str, columns) -> str:
    return " UNION ".join(f"SELECT '{c}' AS var, CAST({c} AS VARCHAR) AS level FROM {table}" for c in columns)


def _missing(column: str) -> str:
    return f"SELECT '{column}' AS var, count(*) AS n_rows, count(*) - count({column}) AS n_missing FROM obs"


_NAMES = [v.name for v in order_catalog().variables]
_SCALED = [*BINNED, *ORDINALS]

ORACLES: dict[str, str] = {
    "scan_obs": ORDERS,
    "extract_query": EXTRACT.format(**_T),
    "stage_checkpoint": SCORED,
    "model_roundtrip": f"{HALVES} SELECT count(*) AS n_rows, count(*) AS n_equal FROM test",
    "set_role": set_role(),
    "select_inputs": f"{OBS} SELECT obs_id, {', '.join([*INTERVALS, *ORDINALS])} FROM obs",
    "split_train_test": f"{SC} SELECT obs_id, CASE WHEN {SPLIT} < {dbl(0.4)} THEN 'train' ELSE 'test' END AS sample FROM s",
    "split_three_way": f"{SC} SELECT obs_id, CASE WHEN {SPLIT} < {dbl(0.4)} THEN 'train' WHEN {SPLIT} < {dbl(0.5)} THEN 'test'"
                       " ELSE 'holdout' END AS sample FROM s",
    "split_exact": f"{SC} SELECT obs_id, row_number() OVER (ORDER BY {uniform('choice')}, obs_id)"
                   f" <= floor((SELECT count(*) FROM s) * {dbl(0.4)}) AS in_sample FROM s",
    "kfold_assign": f"{SC} SELECT obs_id, CAST(floor({uniform('fold')} * 4) AS INT) AS fold FROM s",
    "keyed_uniform": f"WITH e AS ({EVENTS}) SELECT obs_id, {uniform('draw')} AS u FROM e",
    "missing_profile": f"{OBS} SELECT var, n_rows, n_missing, n_missing / CAST(n_rows AS DOUBLE) AS missing_share FROM ("
                       + " UNION ALL ".join(_missing(c) for c in _NAMES) + ")",
    "missing_percent_filter": f"{OBS}, m AS (" + " UNION ALL ".join(_missing(c) for c in _NAMES) + ") "
                              + _catalog_after(f"(SELECT n_missing / CAST(n_rows AS DOUBLE) FROM m WHERE m.var = v.name) > {dbl(0.99)}"),
    "class_level_filter": f"{OBS}, c AS (SELECT var, count(*) AS n FROM ({levels_union('obs', [*ORDINALS, *NOMINALS])}) GROUP BY var) "
                          + _catalog_after("(SELECT n FROM c WHERE c.var = v.name) > 200"),
    "class_level_counts": f"{OBS} SELECT var, count(*) AS n_levels, count(*) > 200 AS rejected FROM"
                          f" ({levels_union('obs', [*ORDINALS, *NOMINALS])}) GROUP BY var",
    "level_profile": f"{OBS} {profile('obs', [*ORDINALS, *NOMINALS, *BINARIES])}",
    "distinct_levels": f"{OBS} {levels_union('obs', [*NOMINALS, *BINARIES])}",
    "column_modes": f"{OBS} " + " UNION ALL ".join(f"SELECT '{c}' AS var, {mode('obs', c)} AS mode" for c in [*NOMINALS, *BINARIES]),
    "quantile_knots": f"{OBS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS var, {dbl(p)} AS prob, count({c}) AS n, {r6(f'quantile_cont({c}, {p})')} AS value FROM obs"
        for c in INTERVALS for p in KNOTS),
    "impute_train": f"{HALVES} {imputed('train', 'train', **ALL_INPUTS)}",
    "impute_test": f"{HALVES} {imputed('train', 'test', **ALL_INPUTS)}",
    "impute_params": impute_params(),
    "impute_interval_distn": f"{OBS} {imputed('obs', 'obs', ['acctbal', 'sum_qty', 'max_price'])}",
    "impute_interval_literal": f"{OBS} {imputed('obs', 'obs', ['acctbal', 'sum_qty', 'max_price'], literal=True)}",
    "impute_constant": f"{OBS} {imputed('obs', 'obs', [], ORDINALS, ['segment'])}",
    "impute_binary_mode": f"{OBS} {imputed('obs', 'obs', [], binaries=BINARIES)}",
    "rare_levels": f"{OBS} SELECT var, level, n, share FROM ({rare('obs', NOMINALS)})",
    "group_rare_train": f"{HALVES}, rare AS ({rare('train', TWO_NOMINAL)}) SELECT obs_id, {pooled('nation')} AS BIN_nation FROM train",
    "group_rare_test": f"{HALVES}, rare AS ({rare('train', ['nation', 'cust_code'])}) SELECT obs_id, {pooled('nation')} AS BIN_nation,"
                       f" {pooled('cust_code')} AS BIN_cust_code FROM test",
    "replacement_params": f"{HALVES} " + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS var, {c} AS level, {mode('train', c)} AS mode FROM train" for c in NOMINALS),
    "replacement_train": f"{HALVES} SELECT obs_id, {', '.join(f'{c} AS REP_{c}' for c in NOMINALS)} FROM train",
    "replacement_test": replacement("test"),
    "new_levels": f"{HALVES} ({levels_union('test', NOMINALS)}) EXCEPT ({levels_union('train', NOMINALS)})",
    "class_histogram": f"{OBS}, {running('obs', BINNED)} SELECT * FROM hist",
    "best_entropy_cut": f"{OBS}, {running('obs', BINNED)}, {mdl_rounds(1)} SELECT var, {r6('(value + nxt) / 2')} AS cut, {r6('gain')} AS gain FROM best0",
    "mdl_cuts": f"{OBS}, {running('obs', BINNED)}, {mdl_rounds()} SELECT var,"
                f" CAST(row_number() OVER (PARTITION BY var ORDER BY cut) - 1 AS INT) AS pos, {r6('cut')} AS cut FROM cuts",
    "bin_apply": f"{HALVES}, {running('train', ['total_price', 'planted'])}, {mdl_rounds()} SELECT obs_id,"
                 " CAST((SELECT count(*) FROM cuts WHERE var = 'planted' AND cut <= planted) AS INT) AS BIN_planted FROM test",
    "corr_matrix": "SELECT 'e' || i AS var_a, 'e' || j AS var_b, "
                   + r6("corr(CAST(embedding[i + 1] AS DOUBLE), CAST(embedding[j + 1] AS DOUBLE))")
                   + " AS corr FROM embeddings, range(0, 64) a(i), range(0, 64) b(j) GROUP BY i, j",
    "cluster_component_score": f"{OBS}, f AS (SELECT obs_id, coalesce(sum_qty, 0) AS a, coalesce(max_price, 0) AS b FROM obs)"
                               f" SELECT obs_id, {r6('(' + zscored('a', 'f') + ' + ' + zscored('b', 'f') + ') / sqrt(2)')} AS PC1_1 FROM f",
    "label_encode": f"{OBS} SELECT var, level, CAST(row_number() OVER (PARTITION BY var ORDER BY level) - 1 AS INT) AS code"
                    f" FROM ({levels_union('obs', [*NOMINALS, *BINARIES])}) WHERE level IS NOT NULL",
    "reject_by_value": f"{_importance()} SELECT var, importance, importance < {dbl(0.01)} AS rejected FROM imp",
    "reject_by_percentage": f"{_importance()}, t AS (SELECT importance AS cut FROM imp ORDER BY importance DESC"
                            " LIMIT 1 OFFSET (SELECT CAST(ceil(count(*) * 0.4) AS BIGINT) - 1 FROM imp))"
                            " SELECT var, importance, CASE WHEN cut = 0 THEN importance = 0 ELSE importance < cut END AS rejected FROM imp, t",
    "final_prep": f"{HALVES} SELECT obs_id, {LABEL}, {', '.join(f'{r6(ranged(c))} AS {c}' for c in _SCALED)}, {FLAG},"
                  f" {dummy_columns('segment', SEGMENTS)}, {dummy_columns('nation', NATIONS)} FROM test",
    "binary_to_ind": f"{OBS} SELECT obs_id, {LABEL}, {FLAG} FROM obs",
    "one_hot": f"{HALVES} SELECT obs_id, {LABEL}, {dummy_columns('segment', SEGMENTS)} FROM test",
    "scale_range": f"{HALVES} SELECT obs_id, {LABEL}, {', '.join(f'{r6(ranged(c))} AS {c}' for c in _SCALED)} FROM test",
    "scale_zscore": f"{HALVES} SELECT obs_id, {LABEL}, {', '.join(f'{r6(zscored(c))} AS {c}' for c in _SCALED)} FROM test",
    "scale_target": f"{HALVES} SELECT obs_id, {r6(ranged(LABEL))} AS ranged, {r6(zscored(LABEL))} AS zscored FROM test",
    "global_rank": f"SELECT obs_id, rk AS rank, CAST(cum AS BIGINT) AS cum_pos FROM ({ranked(SCORED, LABEL)})",
    "lift_at_depth": f"SELECT depth, hits, {LIFT} AS lift FROM ({hits(SCORED, LABEL, LIFT_DEPTHS)})",
    "cum_lift_at_depth": f"SELECT period_dt, depth, hits, hits / nullif(CAST(n_pos AS DOUBLE), 0) AS cum_lift"
                         f" FROM ({hits(SCORED, LABEL, [0.2], 'period_dt')})",
    "gain_curve": f"WITH r AS ({ranked(SCORED, LABEL, 'period_dt')}) SELECT period_dt, rk AS rank, rk / CAST(n AS DOUBLE) AS x,"
                  f" CAST(cum AS DOUBLE) / nullif(CAST(p AS DOUBLE), 0) AS gain FROM r UNION ALL"
                  f" SELECT DISTINCT period_dt, CAST(0 AS BIGINT), {dbl(0)}, {dbl(0)} FROM r",
    "gain_midpoints": f"SELECT k, a / CAST(2 * n AS DOUBLE) AS x, k / CAST(p AS DOUBLE) AS gain FROM ({midpoints(SCORED, LABEL)})",
    "gain_curve_grid": curve_grid(EVENTS, "ev_target_ind"),
    "period_stride": f"SELECT period_dt, CAST(rn AS INT) AS position FROM (SELECT period_dt, row_number() OVER (ORDER BY period_dt) AS rn"
                     f" FROM (SELECT DISTINCT period_dt FROM ({EVENTS}))) WHERE (rn - 1) % 2 = 0",
    "group_by_month": f"{SC} SELECT CAST(month(period_dt) AS INT) AS month, count(*) AS n, {r6(f'avg({LABEL})')} AS target_rate,"
                      f" round(avg({LABEL}) * 100, 2) AS target_pct FROM s GROUP BY 1",
    "lift_stability": curve_grid(every_second(SCORED), LABEL, "period_dt"),
    "decile_stability": f"SELECT period_dt, depth, n, n_pos, hits, {LIFT} AS lift FROM ({hits(every_second(SCORED), LABEL, DECILES, 'period_dt')})",
    "decile_stability_events": f"WITH e AS (SELECT * REPLACE (CAST(date_trunc('month', period_dt) AS DATE) AS period_dt) FROM ({EVENTS}))"
                               f" SELECT period_dt, depth, n, n_pos, hits, {LIFT} AS lift FROM ({hits('SELECT * FROM e', 'ev_target_ind', DECILES, 'period_dt')})",
    "target_rate": f"SELECT period_dt, count(*) AS n, {r6('avg(ev_target_ind)')} AS target_rate, round(avg(ev_target_ind) * 100, 2) AS target_pct"
                   f" FROM ({every_second(EVENTS)}) GROUP BY period_dt",
    "threshold_sweep": f"{SWEEP} SELECT * FROM sweep",
    "fbeta_by_threshold": f"{SWEEP} SELECT j, {r6(fbeta(1))} AS f1, {r6(fbeta(2))} AS f2 FROM sweep",
    "kappa_by_threshold": f"{SWEEP} SELECT j, {r6(KAPPA)} AS kappa FROM sweep",
    "auc_by_threshold": f"{SWEEP} SELECT j, {r6('(tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2')} AS auc FROM sweep",
    "ap_by_threshold": f"{SWEEP} SELECT j, "
                       + r6(f"{RECALL} * coalesce({PRECISION}, 0) + (1 - {RECALL}) * (tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE)") + " AS ap FROM sweep",
    "confusion_matrix": f"{LABELLED} SELECT CAST(a AS INT) AS label, CAST(b AS INT) AS predicted, (SELECT count(*) FROM l WHERE y = a AND z = b) AS n"
                        " FROM range(0, 2) t(a), range(0, 2) u(b)",
    "classification_report": report(),
    "best_params": f"{BLEND_SCORES} SELECT setting, score FROM scores ORDER BY score DESC, setting LIMIT 1",
    "top_models": f"{BLEND_SCORES} SELECT * FROM (SELECT setting, score, CAST(rank() OVER (ORDER BY score DESC) AS INT) AS rank FROM scores) WHERE rank <= 3",
    "param_grid": f"{SC}, t AS (SELECT count(*) AS n FROM s WHERE {SPLIT} < {dbl(0.4)}) SELECT CAST(i AS INT) AS setting,"
                  " round(pow(10, -4 + 8 * i / CAST(49 AS DOUBLE)), 6) AS c, round(1 / (pow(10, -4 + 8 * i / CAST(49 AS DOUBLE)) * n), 9) AS reg_param"
                  " FROM t, range(0, 50) g(i)",
    "param_grid_cross": f"{SC}, t AS (SELECT count(*) AS n FROM s WHERE {SPLIT} < {dbl(0.4)}) SELECT CAST(epochs AS INT) AS epochs,"
                        " CAST(batch_size AS INT) AS batch_size, CAST(ceil(n / CAST(batch_size AS DOUBLE)) AS BIGINT) * epochs AS steps"
                        " FROM t, (VALUES (100), (150), (200), (250)) e(epochs), (VALUES (64), (128), (256)) b(batch_size)",
    "hash_bucket_md5": f"{OBS} SELECT obs_id, CAST(CAST(('0x' || substr(md5(cust_code), 1, 8)) AS BIGINT) % 250 AS INT) AS bucket FROM obs",
    "threshold_sweep_missing": f"{SWEEP_MISSING} SELECT * FROM sweep",
    "confusion_matrix_missing": f"WITH l AS (SELECT {LABEL} AS y, CASE WHEN 1 - p1 < {dbl(0.75)} THEN 1 ELSE 0 END AS z FROM ({GAPPY}))"
                                " SELECT CAST(a AS INT) AS label, CAST(b AS INT) AS predicted,"
                                " (SELECT count(*) FROM l WHERE y = a AND z = b) AS n FROM range(0, 2) t(a), range(0, 2) u(b)",
    "global_rank_missing": f"SELECT obs_id, rk AS rank, CAST(cum AS BIGINT) AS cum_pos FROM ({ranked(GAPPY, LABEL)})",
    "impute_int_nominal": f"{OBS} SELECT obs_id, coalesce(CAST(prio_rank AS VARCHAR), 'Missing') AS IMP_prio_rank FROM obs",
    "group_rare_int": f"{OBS}, x AS (SELECT obs_id, CAST(CASE WHEN obs_id % 500 = 1 THEN 100 + obs_id % 7 ELSE prio_rank END AS VARCHAR) AS code FROM obs),"
                      f" rare AS ({rare('x', ['code'], 0.005)}) SELECT obs_id, {pooled('code')} AS BIN_code FROM x",
    "levels_roundtrip": f"{HALVES} SELECT obs_id, CASE WHEN EXISTS (SELECT 1 FROM train t WHERE t.cust_code = x.cust_code)"
                        " THEN x.cust_code ELSE 'none' END AS REP_cust_code FROM test x",
    "bin_then_group": f"{HALVES}, {running('train', ['planted'])}, {mdl_rounds()},"
                      " bt AS (SELECT CAST((SELECT count(*) FROM cuts WHERE cut <= planted) AS VARCHAR) AS b FROM train),"
                      " bx AS (SELECT obs_id, CAST((SELECT count(*) FROM cuts WHERE cut <= planted) AS VARCHAR) AS b FROM test),"
                      f" rare AS ({rare('bt', ['b'], 0.25)}) SELECT obs_id, {pooled('b')} AS bin FROM bx",
    "one_hot_long": f"{HALVES}, k AS (SELECT cust_code, row_number() OVER (ORDER BY cust_code) - 1 AS code FROM (SELECT DISTINCT cust_code FROM train))"
                    " SELECT obs_id, CAST((SELECT count(*) - 1 FROM k) AS INT) AS width, CASE WHEN code > 0 THEN code - 1 END AS place"
                    " FROM test LEFT JOIN k USING (cust_code)",
    "class_level_filter_approx": f"{OBS} SELECT var, count(*) AS n_levels, true AS near FROM ({levels_union('obs', [*ORDINALS, *NOMINALS])}) GROUP BY var",
    "quantile_knots_approx": f"{OBS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS var, {dbl(p)} AS prob, count({c}) AS n, true AS near FROM obs" for c in INTERVALS for p in KNOTS),
    "cluster_assign": "SELECT DISTINCT 'e' || i AS var, true AS own_ok, true AS next_ok FROM embeddings, range(0, 64) t(i)",
    "cluster_best_vars": "SELECT CAST(max(len(embedding)) AS BIGINT) AS n_columns, CAST(0 AS BIGINT) AS n_wrong, CAST(0 AS BIGINT) AS n_surplus FROM embeddings",
    "tree_importance": f"SELECT var, true AS importance_ok, true AS rule_ok FROM {_imputed_names(FIVE + ORDINALS + TWO_NOMINAL + BINARIES)}",
    "rf_importance": f"SELECT var, true AS importance_ok, true AS rule_ok FROM {_imputed_names(FIVE + ORDINALS + TWO_NOMINAL + BINARIES)}",
    "tree_importance_long": f"SELECT var, true AS importance_ok, true AS rule_ok FROM {_imputed_names(FIVE + ORDINALS + NOMINALS + BINARIES)}",
    "tree_best_first": f"{HALVES} SELECT obs_id, true AS leaf_ok, true AS leaves_ok FROM train",
    "forest_out_of_bag": f"{HALVES} SELECT obs_id, true AS rows_ok, true AS score_ok, true AS learns FROM train",
    "forest_warm_start": f"SELECT var, true AS trees_same, true AS importance_same FROM {_imputed_names(FIVE + ORDINALS + TWO_NOMINAL + BINARIES)}",
    "logit_validation": "SELECT CAST(i AS INT) AS setting, round(pow(10, -4 + 8 * i / CAST(49 AS DOUBLE)), 6) AS c, true AS flat, true AS grows,"
                        " true AS scans_ok FROM range(0, 50) t(i)",
    "score_output": f"{HALVES} SELECT obs_id, true AS p1_ok, true AS label_ok FROM test",
    "mlp_score": f"{HALVES} SELECT obs_id, true AS p1_ok FROM test",
    "mlp_cv": "SELECT CAST(i AS INT) AS setting, CAST(4 AS INT) AS folds, true AS mean_ok, true AS learns FROM range(0, 10) t(i)",
    "mlp_validation": f"{HALVES} SELECT obs_id, true AS p1_ok, true AS label_ok, true AS learns FROM test",
    "mlp_tries": f"{HALVES} SELECT obs_id, true AS p1_ok, true AS label_ok, true AS learns FROM test",
    "hash_bucket": f"{OBS} SELECT obs_id, cust_code, true AS in_range, true AS one_bucket FROM obs",
    "prep_catalog": _prepared_catalog(),
    "prep_roundtrip": f"{HALVES} SELECT obs_id, true AS same FROM test",
    "model_stability": f"{HALVES} SELECT DISTINCT period_dt, depth, true AS hits_ok FROM test, {values([(float(d),) for d in DECILES])} AS d(depth)",
    "logit_arm": f"{HALVES} SELECT obs_id, true AS p1_ok, true AS label_ok, true AS flat FROM test",
    "nn_arm_cv": "SELECT CAST(i AS INT) AS setting, CAST(4 AS INT) AS folds, true AS mean_ok, true AS learns FROM range(0, 10) t(i)",
    "nn_arm": f"{HALVES} SELECT obs_id, true AS p1_ok, true AS label_ok, true AS learns, true AS saved FROM test",
    "extract_ranges": f"{OBS} SELECT obs_id, CAST(1 AS INT) AS held_by, acctbal IS NULL AS in_gap, true AS even FROM obs",
    "merged_levels": f"{OBS} {profile('obs', [*ORDINALS, *NOMINALS, *BINARIES])}",
    "merged_moments": f"{OBS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS var, count(*) AS n_rows, count({c}) AS n, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high,"
        f" {r6(f'avg(CAST({c} AS DOUBLE))')} AS mean, round(stddev_pop(CAST({c} AS DOUBLE)), 4) AS deviation FROM obs" for c in INTERVALS),
    "merged_quantiles": " UNION ALL ".join(f"SELECT '{c}' AS var, {dbl(p)} AS prob, true AS near" for c in INTERVALS for p in KNOTS),
    "stream_target_rate": f"WITH e AS ({EVENTS}) SELECT period_dt, count(*) AS n, CAST(sum(ev_target_ind) AS BIGINT) AS n_pos,"
                          " sum(ev_target_ind) / CAST(count(*) AS DOUBLE) AS target_rate FROM e GROUP BY period_dt",
    "stream_decile_stability": f"WITH e AS ({EVENTS}) SELECT period_dt, depth, count(*) AS n, CAST(sum(ev_target_ind) AS BIGINT) AS n_pos,"
                               f" true AS counts_ok, true AS near FROM e, {values([(float(d),) for d in DECILES])} AS d(depth) GROUP BY period_dt, depth",
    "stream_lift_stability": f"WITH e AS ({EVENTS}) SELECT period_dt, CAST(101 AS BIGINT) AS points, {dbl(0)} AS first, {dbl(1)} AS last, true AS rises"
                             " FROM e GROUP BY period_dt HAVING sum(ev_target_ind) > 0",
    "prep_train": prepared("train"),
    "prep_apply": prepared("test"),
}
