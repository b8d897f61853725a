"""The same results in plain SQL, written for DuckDB.

Each statement is built from the common parts below and shares no code with
the Spark side beyond the metric registry.
"""

from __future__ import annotations

from scoreloom.catalogue.queries import BATCHES, LABELLINGS, PAGE_ROWS, SCENARIO, SCORING_DATE, SILHOUETTE_SAMPLE
from scoreloom.config import BAND_COLOURS, FLAG, PENALTY, RATING_EDGES, RATING_LETTERS, Metric
from scoreloom.operators.metadata import FRAMEWORK_NORMALISATION, VERSION
from scoreloom.presets import CUSTOMER as CARD

SCORES = CARD.all_scores
PILLARS = CARD.pillar_scores
COMPOSITE = CARD.score

ENTITY = """
lines AS (
  SELECT o_custkey AS k, count(*) AS n,
    CAST(sum(date_diff('day', o_orderdate, l_shipdate)) AS DOUBLE) AS lag,
    CAST(count(*) FILTER (l_linestatus = 'F') AS DOUBLE) AS filled,
    CAST(count(*) FILTER (l_returnflag = 'N') AS DOUBLE) AS kept,
    CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
    CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount,
    CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS tax,
    CAST(count(DISTINCT l_partkey) AS DOUBLE) AS parts,
    count(DISTINCT l_suppkey) AS suppliers
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
heads AS (
  SELECT o_custkey AS k,
    count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
    count(*) FILTER (o_orderstatus = 'P') AS pending,
    max(o_totalprice) / nullif(min(o_totalprice), 0e0) AS spread,
    count(DISTINCT o_orderpriority) AS priorities
  FROM orders GROUP BY o_custkey),
entity AS (
  SELECT c_custkey AS customer_key, c_name AS customer, c_mktsegment AS segment, n_name AS country,
    lag / n AS ship_lag_days, 100e0 * filled / n AS fulfilled_pct, tax / n AS avg_tax,
    100e0 * kept / n AS kept_pct, urgent AS urgent_orders, 100e0 * returned / n AS return_pct,
    100e0 * parts / n AS part_diversity_pct, discount / n AS avg_discount, price AS revenue,
    pending AS pending_orders, c_acctbal AS account_balance, spread AS price_spread_ratio,
    suppliers AS supplier_breadth,
    CASE WHEN c_acctbal > 0 THEN 1 WHEN c_acctbal IS NOT NULL THEN 0 END AS in_credit,
    priorities AS priority_breadth
  FROM customer LEFT JOIN lines ON lines.k = c_custkey LEFT JOIN heads ON heads.k = c_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
  WHERE c_custkey IS NOT NULL)"""


def _num(value: float) -> str:
    return f"{float(value)!r}e0"


def _round(x: str, digits: int = 1) -> str:
    scale = _num(10**digits)
    return f"round_even(({x}) * {scale}, 0) / {scale}"


def _input(m: Metric, linear: bool = False) -> str:
    x = f"CAST({m.column} AS DOUBLE)"
    return f"ln(1e0 + {x})" if m.log1p and not linear else x


def _bounds(name: str, metrics: list[Metric], linear: bool) -> str:
    ends = ", ".join(
        f"min({_input(m, linear)}) AS {m.column}_lo, max({_input(m, linear)}) AS {m.column}_hi" for m in metrics
    )
    return f"{name} AS (SELECT {ends} FROM entity)"


def _scaled_100(m: Metric, linear: bool = False) -> str:
    lo, hi = f"{m.column}_lo", f"{m.column}_hi"
    scaled = f"({_input(m, linear)} - {lo}) / ({hi} - {lo}) * 100e0"
    return f"CASE WHEN {hi} = {lo} THEN 50e0 ELSE {f'100e0 - {scaled}' if m.lower_is_better else scaled} END"


def _scaled_01(m: Metric) -> str:
    lo, hi = f"{m.column}_lo", f"{m.column}_hi"
    scaled = f"({_input(m, True)} - {lo}) / ({hi} - {lo})"
    return f"CASE WHEN {hi} > {lo} THEN {f'1e0 - {scaled}' if m.lower_is_better else scaled} ELSE 0.5e0 END"


def _clip(x: str, low: float, high: float) -> str:
    return f"CASE WHEN {x} < {_num(low)} THEN {_num(low)} WHEN {x} > {_num(high)} THEN {_num(high)} ELSE {x} END"


def _term(m: Metric) -> str:
    if m.kind == PENALTY:
        x = f"CAST({m.column} AS DOUBLE)"
        return f"- ({_clip(x, 0, m.cap)}) / {_num(m.cap)} * {_num(m.points)} * {_num(m.weight)}"
    if m.kind == FLAG:
        return f"+ CAST({m.column} AS DOUBLE) * 100e0 * {_num(m.weight)}"
    return f"+ ({_scaled_100(m)}) * {_num(m.weight)}"


def _pillar_raw(slug: str) -> str:
    return " ".join(_term(m) for m in CARD.of_pillar(slug)).removeprefix("+ ")


def _weighted(weights: dict[str, float]) -> str:
    return _round(" + ".join(f"{p.score} * {_num(weights[p.slug])}" for p in CARD.pillars))


def _rating(x: str) -> str:
    bins = zip(RATING_LETTERS, RATING_EDGES, RATING_EDGES[1:])
    cases = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{name}'" for name, lo, hi in bins)
    return f"CASE {cases} END"


def _band(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 75 THEN 'Leader' WHEN {x} >= 55 THEN 'Average' "
        f"WHEN {x} >= 35 THEN 'Laggard' ELSE 'Critical' END"
    )


def _mean(score: str) -> str:
    total = f"CAST(sum(CAST({score} AS DECIMAL(18,1))) AS DOUBLE)"
    return _round(f"{total} / count({score})")


def _cases(x: str, values: dict[str, str]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def _statement(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select


def _recursive(ctes: list[str], select: str) -> str:
    return _statement(ctes, select).replace("WITH ", "WITH RECURSIVE ", 1)


_CLIPPED = ", ".join(f"{_round(_clip(f'raw_{p.slug}', 0, 100))} AS {p.score}" for p in CARD.pillars)
_RAW = ", ".join(f"{_pillar_raw(p.slug)} AS raw_{p.slug}" for p in CARD.pillars)
_ALL_BANDS = ", ".join(
    f"{_band(s)} AS {b}"
    for s, b in [(COMPOSITE, CARD.band), *((p.score, f"{p.slug}_band") for p in CARD.pillars)]
)
SCORED = [
    ENTITY,
    _bounds("bounds", CARD.scaled, linear=False),
    f"raws AS (SELECT entity.*, {_RAW} FROM entity, bounds)",
    f"pillars AS (SELECT * EXCLUDE ({', '.join(f'raw_{p.slug}' for p in CARD.pillars)}), {_CLIPPED} FROM raws)",
    f"composed AS (SELECT *, {_weighted(CARD.weights)} AS {COMPOSITE} FROM pillars)",
    f"scored AS (SELECT *, {_rating(COMPOSITE)} AS {CARD.rating}, {_ALL_BANDS} FROM composed)",
]
NORMALISED = [
    ENTITY,
    _bounds("bounds", list(CARD.metrics), linear=True),
    "norm AS (SELECT customer_key, customer, segment, country, "
    + ", ".join(f"{_scaled_01(m)} AS {m.column}" for m in CARD.metrics)
    + " FROM entity, bounds)",
]


def _row_mean(slug: str) -> str:
    columns = [m.column for m in CARD.of_pillar(slug)]
    total = " + ".join(f"coalesce({c}, 0e0)" for c in columns)
    present = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in columns)
    return _round(f"({total}) / nullif({present}, 0) * 100e0")


EQUAL = [
    *NORMALISED,
    "equal AS (SELECT customer_key, customer, segment, country, "
    + ", ".join(f"{_row_mean(p.slug)} AS {p.score}" for p in CARD.pillars)
    + " FROM norm)",
]
_GAP = _round(f"{COMPOSITE}_pca - {COMPOSITE}_hardcoded")
COMPARED = [
    *EQUAL,
    f"both_ways AS (SELECT *, {_weighted(CARD.weights)} AS {COMPOSITE}_hardcoded, "
    f"{_weighted(SCENARIO)} AS {COMPOSITE}_pca FROM equal)",
    f"compared AS (SELECT *, {_GAP} AS score_delta FROM both_ways)",
]


def _percentile(score: str) -> str:
    average = f"rank() OVER (PARTITION BY segment ORDER BY {score} NULLS LAST) + "
    average += f"(count({score}) OVER (PARTITION BY segment, {score}) - 1) / 2e0"
    share = f"({average}) / count({score}) OVER (PARTITION BY segment) * 100e0"
    return f"CASE WHEN {score} IS NOT NULL AND segment IS NOT NULL THEN {_round(share)} END AS {score}_segment_pct"


_PERCENTILES = ", ".join(_percentile(s) for s in SCORES)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _long(columns: str, extra: str = "") -> str:
    return _union([f"SELECT {columns}, {p.score} AS pillar_score, '{p.label}' AS pillar{extra.format(p)} FROM scored" for p in CARD.pillars])


_DETAIL = _union(
    [
        f"SELECT customer_key, customer, segment, country, '{CARD.pillar_label(m.pillar)}' AS pillar, "
        f"'{m.label}' AS metric_name, {_input(m, True)} AS raw_value, "
        f"{_round(_scaled_100(m, True))} AS normalised_score, {str(m.lower_is_better).lower()} AS lower_is_better "
        "FROM entity, bounds"
        for m in CARD.scaled
    ]
)
_GROUP_AVERAGES = ", ".join(f"{_mean(s)} AS {s}" for s in SCORES)
_RADAR_NAMES = {p.score: f"{p.label} Score" for p in CARD.pillars} | {COMPOSITE: "Composite Score"}
_RADAR = _union(
    [f"SELECT side, customer_key, customer, '{name}' AS category, {s} AS score FROM ends" for s, name in _RADAR_NAMES.items()]
)
_TOP = f"customer_key, customer, segment, {', '.join(SCORES)}, {CARD.rating}"


def _describe(m: Metric) -> str:
    c = m.column
    figures = {
        "mean": f"avg({c})",
        "std": f"stddev_samp({c})",
        "min": f"min({c})",
        "q25": f"quantile_cont({c}, 0.25)",
        "q50": f"quantile_cont({c}, 0.5)",
        "q75": f"quantile_cont({c}, 0.75)",
        "max": f"max({c})",
    }
    columns = ", ".join(f'{_round(x, 3)} AS "{name}"' for name, x in figures.items())
    return f"SELECT '{c}' AS metric, count({c}) AS n, {columns} FROM norm"


def _archetype() -> str:
    cases = " ".join(
        "WHEN " + " AND ".join(f"avg_{name} {how} {bound}" for name, how, bound in a.conditions) + f" THEN '{a.name}'"
        for a in CARD.archetypes
    )
    return f"CASE {cases} ELSE '{CARD.default_archetype}' END"


_PROFILE_MEANS = ", ".join(
    [*(f"{_mean(p.score)} AS avg_{p.slug}" for p in CARD.pillars), f"{_mean(f'{COMPOSITE}_pca')} AS avg_{CARD.name}"]
)
PROFILES = [
    *COMPARED,
    f"means AS (SELECT country, count(customer) AS n_customers, {_PROFILE_MEANS} FROM compared "
    "WHERE country IS NOT NULL GROUP BY country)",
    f"profiles AS (SELECT *, {_archetype()} AS archetype FROM means)",
]
_Z = ", ".join(
    f"{_round(f'CASE WHEN stddev_pop({c}) OVER () = 0 THEN {c} * 0e0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END', 6)} AS {c}"
    for c in CARD.metric_columns
)


# Principal components: the correlation matrix of complete rows, as a list of
# lists, squared again and again until only its first component is left; then
# that component goes, for the next.
_SIZE = len(CARD.metric_columns)
_SQUARINGS = 24
_CORRELATIONS = ", ".join(
    "[" + ", ".join(f"coalesce(CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END, 0e0)" for b in CARD.metric_columns) + "]"
    for a in CARD.metric_columns
)


def _trace(m: str) -> str:
    return f"list_sum([{m}[i][i] FOR i IN range(1, {_SIZE + 1})])"


def _component(j: int) -> list[str]:
    """Matrix c{j} gives share s, signed loadings v and what is left, c{j + 1}."""
    return [
        f"""p{j}(step, m) AS (
  SELECT 0, m FROM c{j}
  UNION ALL
  SELECT step + 1, [[x / {_trace('q')} FOR x IN r] FOR r IN q]
  FROM (SELECT step, [[list_dot_product(a, b) FOR b IN m] FOR a IN m] AS q FROM p{j} WHERE step < {_SQUARINGS}))""",
        # All rows of what is left are the component by a factor; the longest is the safest.
        f"r{j} AS (SELECT list_reverse_sort([{{'size': list_dot_product(a, a), 'row': a}} FOR a IN m])[1].row AS a FROM p{j} WHERE step = {_SQUARINGS})",
        f"u{j} AS (SELECT [x / sqrt(list_dot_product(a, a)) FOR x IN a] AS u FROM r{j})",
        f"""v{j} AS (SELECT [x * sign(u[list_position(sizes, list_max(sizes))]) FOR x IN u] AS v
  FROM (SELECT u, [round(abs(x), 9) FOR x IN u] AS sizes FROM u{j}))""",
        f"l{j} AS (SELECT v, m, list_dot_product(v, [list_dot_product(a, v) FOR a IN m]) AS l FROM v{j}, c{j})",
        f"c{j + 1} AS (SELECT [[m[i][k] - l * v[i] * v[k] FOR k IN range(1, {_SIZE + 1})] FOR i IN range(1, {_SIZE + 1})] AS m FROM l{j})",
    ]


_METRIC_ROWS = ", ".join(
    f"({i}, '{m.column}', '{CARD.pillar_label(m.pillar)}')" for i, m in enumerate(CARD.metrics, 1)
)
_PILLAR_ROWS = ", ".join(f"('{p.slug}', '{p.label}', {_num(p.weight)})" for p in CARD.pillars)
COMPONENTS = [
    *NORMALISED,
    "complete AS (SELECT * FROM norm WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in CARD.metric_columns) + ")",
    f"c1 AS (SELECT [{_CORRELATIONS}] AS m FROM complete)",
    *(part for j in (1, 2, 3) for part in _component(j)),
    "found AS ("
    + _union([f"SELECT 'PC{j}' AS component, v, l / (SELECT {_trace('m')} FROM c1) AS explained FROM l{j}" for j in (1, 2, 3)])
    + ")",
    f"registry(i, metric, pillar) AS (VALUES {_METRIC_ROWS})",
    "loadings AS (SELECT component, metric, pillar, v[i] AS loading FROM found, registry)",
    "affinities AS (SELECT component, pillar, avg(abs(loading)) AS affinity FROM loadings GROUP BY ALL)",
    "dominant AS (SELECT component, pillar AS dominant_pillar FROM affinities "
    "QUALIFY row_number() OVER (PARTITION BY component ORDER BY affinity DESC, pillar) = 1)",
    f"parts AS (SELECT component, {_round('explained * 100')} AS explained_variance_pct, dominant_pillar, explained "
    "FROM found JOIN dominant USING (component))",
    f"registered(slug, pillar, fixed_weight) AS (VALUES {_PILLAR_ROWS})",
    "weights AS (SELECT slug, pillar, coalesce((SELECT sum(explained) FROM parts WHERE dominant_pillar = pillar), 0e0) "
    "/ (SELECT sum(explained) FROM parts) AS weight, fixed_weight FROM registered)",
]
_OWN_WEIGHTS = _round(" + ".join(f"{p.score} * (SELECT weight FROM weights WHERE slug = '{p.slug}')" for p in CARD.pillars))


def _silhouette(distance: str, label: str = "label") -> str:
    return f"""
WITH p AS (SELECT vec_id, {label} AS label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND label IS NOT NULL),
sizes AS (SELECT label, count(*) AS n FROM p GROUP BY label),
sums AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({distance}) AS d
         FROM p a, p b GROUP BY ALL),
sides AS (SELECT vec_id,
    max(CASE WHEN own = other THEN n END) AS size,
    max(CASE WHEN own = other AND n > 1 THEN d / (n - 1) END) AS a,
    min(CASE WHEN own <> other THEN d / n END) AS b
  FROM sums JOIN sizes ON sizes.label = other GROUP BY vec_id)
SELECT {_round('avg(CASE WHEN size <= 1 THEN 0e0 WHEN greatest(a, b) = 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END)', 3)}
  AS silhouette FROM sides"""


FENCED = [
    *SCORED,
    f"""boxes AS (SELECT segment, count(*) AS entities,
  {', '.join(f"{_round(f'quantile_cont({COMPOSITE}, {q / 100})', 3)} AS q{q}" for q in (25, 50, 75))}
FROM scored WHERE segment IS NOT NULL AND {COMPOSITE} IS NOT NULL GROUP BY segment)""",
    f"""fenced AS (SELECT *, {_round('q25 - 1.5e0 * (q75 - q25)', 4)} AS low_fence,
  {_round('q75 + 1.5e0 * (q75 - q25)', 4)} AS high_fence FROM boxes)""",
]


def _long_values(measures: list[str]) -> str:
    return _union([f"SELECT '{m}' AS measure, CAST({m} AS DOUBLE) AS v FROM scored WHERE {m} IS NOT NULL" for m in measures])


# The least of 1, 2, 5 times a power of ten with which all values lie in ten bins.
BINNED = [
    *SCORED,
    f"vals AS ({_long_values([*SCORES, *CARD.metric_columns])})",
    "spans AS (SELECT measure, min(v) AS lo, max(v) AS hi FROM vals GROUP BY measure)",
    "steps AS (SELECT CASE WHEN p < 0 THEN f / CAST('1e' || -p AS DOUBLE) ELSE f * CAST('1e' || p AS DOUBLE) END AS step "
    "FROM (SELECT unnest(generate_series(-12, 15)) AS p), (VALUES (1e0), (2e0), (5e0)) AS factors(f))",
    "chosen AS (SELECT measure, lo, hi, CASE WHEN lo = hi THEN 1e0 ELSE min(step) END AS step FROM spans, steps "
    "WHERE lo = hi OR floor(hi / step) - floor(lo / step) < 10 GROUP BY measure, lo, hi)",
    "bins AS (SELECT measure, step, unnest(generate_series(CAST(floor(lo / step) AS BIGINT), CAST(floor(hi / step) AS BIGINT))) AS b, "
    "CAST(floor(lo / step) AS BIGINT) AS first FROM chosen)",
    "hits AS (SELECT measure, CAST(floor(v / step) AS BIGINT) AS b, count(*) AS n FROM vals JOIN chosen USING (measure) GROUP BY ALL)",
]
DENSITY = [
    *SCORED,
    f"parts AS (SELECT false AS whole, segment, {COMPOSITE} AS x FROM scored WHERE {COMPOSITE} IS NOT NULL AND segment IS NOT NULL "
    f"UNION ALL SELECT true, NULL, {COMPOSITE} FROM scored WHERE {COMPOSITE} IS NOT NULL)",
    "widths AS (SELECT whole, segment, count(*) AS n, 1.06e0 * stddev_samp(x) * pow(count(*), -0.2e0) AS h FROM parts GROUP BY ALL HAVING count(*) > 1 AND min(x) < max(x))",
    "curve AS (SELECT w.whole, w.segment, h, CAST(g AS DOUBLE) AS point, sum(exp(-0.5e0 * pow((g - x) / h, 2))) / (n * h * sqrt(2e0 * pi())) AS density "
    "FROM widths w JOIN parts p ON w.whole = p.whole AND w.segment IS NOT DISTINCT FROM p.segment, (SELECT unnest(generate_series(0, 100)) AS g) "
    "GROUP BY w.whole, w.segment, h, n, g)",
]


def _moments(m: Metric, linear: bool) -> str:
    x = _input(m, linear)
    figures = {"lo": f"min({x})", "hi": f"max({x})", "mean": f"avg({x})", "dev": f"stddev_pop({x})"}
    return (
        f"SELECT '{m.column}' AS metric, '{'linear' if linear else 'scaled'}' AS form, count({x}) AS n, "
        + ", ".join(f"{_round(f, 6)} AS {name}" for name, f in figures.items())
        + " FROM entity"
    )


def _moved(m: Metric) -> str:
    x = _input(m)
    first = f"FILTER (customer_key % {BATCHES} = 0)"
    return f"SELECT '{m.column}' AS metric, min({x}) {first} AS lo, max({x}) {first} AS hi, min({x}) AS new_lo, max({x}) AS new_hi FROM entity"


def _group_shares(score: str) -> str:
    return f"SELECT DISTINCT segment, '{score}' AS measure, {score} AS score, {_percentile(score).rsplit(' AS ', 1)[0]} AS pct FROM scored WHERE segment IS NOT NULL"


_COMPLETE = " AND ".join(f"{p} IS NOT NULL" for p in PILLARS)
_CHECKS = "(VALUES ('numbering'), ('sizes'), ('means'), ('archetypes'), ('missing')) AS checks(\"check\")"
_SAMPLED = f"""
WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
sizes AS (SELECT label, count(*) AS n FROM p GROUP BY label),
drawn AS (SELECT p.* FROM p JOIN sizes USING (label)
  WHERE CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) < 4294967296e0 * {SILHOUETTE_SAMPLE} / n),
sums AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.e, b.e)) AS d FROM drawn a, p b GROUP BY ALL),
sides AS (SELECT vec_id, own AS label, max(CASE WHEN own = other THEN n END) AS size,
    max(CASE WHEN own = other THEN d / greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> other THEN d / n END) AS b
  FROM sums JOIN sizes ON sizes.label = other GROUP BY ALL),
widths AS (SELECT label, CASE WHEN size = 1 OR greatest(a, b) = 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END AS s FROM sides),
clusters AS (SELECT label, n AS rows, count(s) AS sampled, avg(s) AS silhouette,
    CASE WHEN count(s) = n THEN 0e0 ELSE sqrt(var_samp(s) / count(s) * (1 - count(s) / n)) END AS standard_error
  FROM sizes LEFT JOIN widths USING (label) GROUP BY label, n),
every AS (SELECT * FROM clusters UNION ALL
  SELECT NULL, CAST(sum(rows) AS BIGINT), CAST(sum(sampled) AS BIGINT),
    CASE WHEN count(silhouette) = count(*) THEN sum(rows * silhouette) / sum(rows) END,
    CASE WHEN count(standard_error) = count(*) THEN sqrt(sum(pow(rows * standard_error, 2))) / sum(rows) END FROM clusters)
SELECT label, rows, sampled, {_round('silhouette', 6)} AS silhouette, {_round('standard_error', 6)} AS standard_error FROM every"""

_PILLAR_JSON = ", ".join(
    f"'{p.label}': {{'weight': '{p.weight:.0%}', 'metrics': [{', '.join(repr(m.name) for m in CARD.of_pillar(p.slug))}]}}"
    for p in CARD.pillars
)
_BAND_JSON = ", ".join(
    f"'{name}': '{lo}–{hi}'" for name, lo, hi in reversed(list(zip(RATING_LETTERS, RATING_EDGES, RATING_EDGES[1:])))
)
_X, _Y, _BUBBLE = CARD.pillars

ORACLE: dict[str, str] = {
    "entity_metrics": _statement([ENTITY], "SELECT * FROM entity"),
    "load_profile": "SELECT count(*) AS entities, count(DISTINCT c_mktsegment) AS groups FROM customer "
    "WHERE c_custkey IS NOT NULL",
    "universe_stats": _statement([ENTITY, _bounds("bounds", list(CARD.metrics), True)], "SELECT * FROM bounds"),
    "normalised_metrics": _statement(
        NORMALISED,
        "SELECT customer_key, " + ", ".join(f"{_round(c, 6)} AS {c}" for c in CARD.metric_columns) + " FROM norm",
    ),
    "scaled_metrics": _statement(
        SCORED[:2],
        "SELECT customer_key, "
        + ", ".join(f"{_round(_scaled_100(m), 4)} AS {m.column}" for m in CARD.scaled)
        + " FROM entity, bounds",
    ),
    "pillar_scores": _statement(SCORED[:4], f"SELECT customer_key, {', '.join(PILLARS)} FROM pillars"),
    "scorecard_master": _statement(SCORED, f"SELECT *, {_PERCENTILES} FROM scored"),
    "group_percentiles": _statement(SCORED, f"SELECT customer_key, segment, {_PERCENTILES} FROM scored"),
    "scores_long": _statement(
        SCORED, _long(f"customer_key, customer, segment, country, {COMPOSITE}, {CARD.rating}, {CARD.band}")
    ),
    "metric_detail": _statement([ENTITY, _bounds("bounds", CARD.scaled, True)], _DETAIL),
    "group_summary": _statement(
        SCORED,
        f"""SELECT segment, count(customer_key) AS customer_count, {_mean(COMPOSITE)} AS avg_{CARD.name},
  {', '.join(f'{_mean(p.score)} AS avg_{p.slug}' for p in CARD.pillars)},
  first(customer ORDER BY {COMPOSITE} DESC NULLS LAST, customer_key) AS top_customer,
  max({COMPOSITE}) AS top_{CARD.name}
FROM scored WHERE segment IS NOT NULL GROUP BY segment""",
    ),
    "group_averages": _statement(
        SCORED, f"SELECT segment, {_GROUP_AVERAGES} FROM scored WHERE segment IS NOT NULL GROUP BY segment"
    ),
    "top_entities": _statement(
        SCORED, f"SELECT {_TOP} FROM scored ORDER BY {COMPOSITE} DESC NULLS LAST, customer_key LIMIT 5"
    ),
    "bottom_entities": _statement(
        SCORED, f"SELECT {_TOP} FROM scored ORDER BY {COMPOSITE} ASC NULLS LAST, customer_key LIMIT 5"
    ),
    "extremes_radar": _statement(
        [
            *SCORED,
            "ends AS ("
            f"(SELECT 'top' AS side, * FROM scored ORDER BY {COMPOSITE} DESC NULLS LAST, customer_key LIMIT 3) UNION ALL "
            f"(SELECT 'bottom' AS side, * FROM scored ORDER BY {COMPOSITE} ASC NULLS LAST, customer_key LIMIT 3))",
        ],
        _RADAR,
    ),
    "leaderboard": _statement(
        SCORED,
        f"""SELECT customer_key, customer, segment, {COMPOSITE}, {CARD.band},
  {_cases(CARD.band, BAND_COLOURS)} AS colour,
  coalesce(CAST({COMPOSITE} AS VARCHAR), 'nan') || ' (' || coalesce({CARD.rating}, 'nan') || ')' AS score_label,
  row_number() OVER (ORDER BY {COMPOSITE} DESC NULLS LAST, customer_key) AS position
FROM scored""",
    ),
    "pillar_breakdown": _statement(SCORED, _long(f"customer_key, customer, {COMPOSITE}", ", '{0.colour}' AS colour")),
    "quadrants": _statement(
        SCORED,
        f"""SELECT customer_key, customer, segment, {_X.score} AS x, {_Y.score} AS y, {_BUBBLE.score} AS bubble,
  {COMPOSITE},
  CASE WHEN {_X.score} >= 50 AND {_Y.score} >= 50 THEN '{_X.label} and {_Y.label}'
       WHEN {_X.score} >= 50 AND {_Y.score} < 50 THEN '{_X.label} only'
       WHEN {_X.score} < 50 AND {_Y.score} >= 50 THEN '{_Y.label} only'
       WHEN {_X.score} < 50 AND {_Y.score} < 50 THEN 'Neither' END AS quadrant
FROM scored""",
    ),
    "group_heatmap": _statement(
        SCORED,
        "SELECT segment, "
        + ", ".join(f'{_mean(p.score)} AS "{p.label}"' for p in CARD.pillars)
        + f', {_mean(COMPOSITE)} AS "{CARD.composite_label}" FROM scored WHERE segment IS NOT NULL GROUP BY segment',
    ),
    "score_histogram": _statement(
        [*SCORED, f"bins AS (SELECT CAST(least(floor({COMPOSITE} / 10e0), 9) AS BIGINT) AS bin FROM scored WHERE {COMPOSITE} IS NOT NULL)"],
        "SELECT bin, bin * 10e0 AS low, (bin + 1) * 10e0 AS high, count(*) AS entities FROM bins GROUP BY bin",
    ),
    "group_box_stats": _statement(
        SCORED,
        f"""SELECT segment, count({COMPOSITE}) AS entities, min({COMPOSITE}) AS low,
  {', '.join(f"{_round(f'quantile_cont({COMPOSITE}, {q / 100})', 3)} AS q{q}" for q in (25, 50, 75))},
  max({COMPOSITE}) AS high
FROM scored WHERE segment IS NOT NULL GROUP BY segment""",
    ),
    "box_fences": _statement(
        FENCED,
        f"""SELECT segment, entities, q25, q50, q75, low_fence, high_fence,
  min({COMPOSITE}) FILTER ({COMPOSITE} BETWEEN low_fence AND high_fence) AS low_whisker,
  max({COMPOSITE}) FILTER ({COMPOSITE} BETWEEN low_fence AND high_fence) AS high_whisker,
  count(*) FILTER ({COMPOSITE} < low_fence OR {COMPOSITE} > high_fence) AS outliers
FROM scored JOIN fenced USING (segment) WHERE {COMPOSITE} IS NOT NULL GROUP BY ALL""",
    ),
    "box_points": _statement(
        [
            *FENCED,
            f"points AS (SELECT segment, customer_key, customer, {COMPOSITE}, row_number() OVER (PARTITION BY segment ORDER BY {COMPOSITE}, customer_key) AS position, "
            f"{COMPOSITE} < low_fence OR {COMPOSITE} > high_fence AS outlier FROM scored JOIN fenced USING (segment) WHERE {COMPOSITE} IS NOT NULL)",
        ],
        f"SELECT *, CAST((position - 1) // {PAGE_ROWS} AS INTEGER) AS page FROM points",
    ),
    "score_density": _statement(
        DENSITY, f"SELECT segment, whole, {_round('h', 9)} AS bandwidth, point, {_round('density', 9)} AS density FROM curve"
    ),
    "chosen_bins": _statement(
        BINNED,
        "SELECT measure, b - first AS bin, b * step AS low, (b + 1) * step AS high, coalesce(n, 0) AS entities FROM bins LEFT JOIN hits USING (measure, b)",
    ),
    "sketched_quartiles": _statement(
        [ENTITY, "counts AS (" + _union([f"SELECT '{m.column}' AS metric, count({m.column}) AS n FROM entity" for m in CARD.metrics]) + ")"],
        "SELECT metric, prob, n, true AS within FROM counts, (VALUES (0.25e0), (0.5e0), (0.75e0)) AS asked(prob) WHERE n > 0",
    ),
    "sketched_counts": _union(
        [
            f"SELECT '{c}' AS \"column\", count(DISTINCT coalesce(CAST(date_trunc('month', o_orderdate) AS VARCHAR), '')) AS parts, count(*) AS rows, "
            f"count(DISTINCT {c}) AS exact, true AS within FROM orders"
            for c in ("o_custkey", "o_orderdate", "o_orderpriority")
        ]
    ),
    "merged_percentiles": _statement(
        [*SCORED, "shares AS (" + _union([_group_shares(s) for s in SCORES]) + ")"], "SELECT * FROM shares WHERE score IS NOT NULL"
    ),
    "merged_moments": _statement([ENTITY], _union([_moments(m, True) for m in CARD.metrics] + [_moments(m, False) for m in CARD.scaled])),
    "moved_bounds": _statement(
        [ENTITY, "bounds AS (" + _union([_moved(m) for m in CARD.scaled]) + ")"],
        "SELECT * FROM bounds WHERE lo IS DISTINCT FROM new_lo OR hi IS DISTINCT FROM new_hi",
    ),
    "registry_scorecard": _statement(SCORED[:4], f"SELECT customer_key, {', '.join(PILLARS)} FROM pillars"),
    "metric_describe": _statement(NORMALISED, _union([_describe(m) for m in CARD.metrics])),
    "equal_weight_pillars": _statement(EQUAL, "SELECT * FROM equal"),
    "weight_comparison": _statement(
        COMPARED,
        f"SELECT customer_key, customer, {COMPOSITE}_hardcoded, {COMPOSITE}_pca, score_delta FROM compared",
    ),
    "standardised_metrics": _statement(NORMALISED, f"SELECT customer_key, {_Z} FROM norm"),
    "country_profiles": _statement(PROFILES, "SELECT * FROM profiles"),
    "country_members": _statement(
        [
            *PROFILES,
            "placed AS (SELECT country, customer, row_number() OVER (PARTITION BY country "
            "ORDER BY customer, customer_key) AS position FROM compared WHERE country IS NOT NULL)",
            f"pages AS (SELECT country, CAST((position - 1) // {PAGE_ROWS} AS INTEGER) AS page, "
            "string_agg(customer, ', ' ORDER BY position) AS customers FROM placed GROUP BY ALL)",
        ],
        "SELECT pages.country, page, customers, n_customers, archetype FROM pages JOIN profiles USING (country)",
    ),
    "pca_variance": _recursive(
        COMPONENTS,
        f"SELECT component, explained_variance_pct, dominant_pillar, {_round('explained', 6)} AS explained FROM parts",
    ),
    "pca_loadings": _recursive(
        COMPONENTS, f"SELECT component, metric, pillar, {_round('loading', 6)} AS loading FROM loadings"
    ),
    "pca_affinity": _recursive(
        COMPONENTS, f"SELECT component, pillar, {_round('affinity', 6)} AS affinity FROM affinities"
    ),
    "pca_weights": _recursive(
        COMPONENTS,
        f"SELECT slug, pillar, {_round('weight', 6)} AS weight, format('{{:.1f}}%', {_round('weight * 100')}) AS weight_text, "
        "CAST(fixed_weight AS DOUBLE) AS fixed_weight FROM weights",
    ),
    "pca_weight_comparison": _recursive(
        [
            *COMPONENTS,
            EQUAL[-1],
            f"both_ways AS (SELECT *, {_weighted(CARD.weights)} AS {COMPOSITE}_hardcoded, {_OWN_WEIGHTS} AS {COMPOSITE}_pca FROM equal)",
        ],
        f"SELECT *, {_GAP} AS score_delta FROM both_ways",
    ),
    "numbered_countries": _statement(
        [
            *COMPARED,
            f"ranked AS (SELECT country, row_number() OVER (ORDER BY sum(CAST({COMPOSITE}_pca AS DECIMAL(18,1))) / count({COMPOSITE}_pca) NULLS FIRST, country) - 1 AS n "
            "FROM compared WHERE country IS NOT NULL GROUP BY country)",
        ],
        f"SELECT customer_key, compared.country, {COMPOSITE}_pca, CAST(n AS INTEGER) AS cluster_id FROM compared LEFT JOIN ranked USING (country)",
    ),
    "customer_archetypes": _statement(
        PROFILES, "SELECT customer_key, compared.country, archetype FROM compared LEFT JOIN profiles USING (country)"
    ),
    "labelling_choice": "WITH found AS ("
    + _union(
        [f"SELECT {k} AS k, silhouette FROM ({_silhouette('list_distance(a.e, b.e) ** 2', f'label % {k}')})" for k in LABELLINGS]
    )
    + ") SELECT k, silhouette, row_number() OVER (ORDER BY silhouette DESC, k) = 1 AS chosen FROM found",
    "silhouette_sampled": _SAMPLED,
    "kmeans_audit": _statement(
        [*EQUAL, f"complete AS (SELECT {', '.join(PILLARS)} FROM equal WHERE {_COMPLETE})"],
        "SELECT CAST(k AS INTEGER) AS k, (SELECT count(*) FROM (SELECT DISTINCT * FROM complete)) AS points, (SELECT count(*) FROM complete) AS weight, "
        "CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS off_centre, CAST(0 AS BIGINT) AS empty FROM (SELECT unnest(generate_series(2, 6)) AS k)",
    ),
    "profile_audit": _statement(
        [*EQUAL, f"complete AS (SELECT count(*) AS checked FROM equal WHERE {_COMPLETE})"],
        f'SELECT "check", checked, CAST(0 AS BIGINT) AS wrong FROM complete, {_CHECKS}',
    ),
    "silhouette_exact": _silhouette("list_distance(a.e, b.e)"),
    "silhouette_squared": _silhouette("list_distance(a.e, b.e) ** 2"),
    "framework_metadata": f"""SELECT '{VERSION}' AS version, '{SCORING_DATE}' AS scoring_date,
  CAST(to_json({{{_PILLAR_JSON}}}) AS VARCHAR) AS pillars,
  CAST(to_json({{{_BAND_JSON}}}) AS VARCHAR) AS rating_bands,
  '{FRAMEWORK_NORMALISATION}' AS normalisation, count(*) AS customers_scored
FROM customer WHERE c_custkey IS NOT NULL""",
}
