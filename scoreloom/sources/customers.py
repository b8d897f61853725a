"""The customer entity table: fifteen metrics per customer of a star schema."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from scoreloom.functions.expressions import num
from scoreloom.plans.staging import stage
from scoreloom.sources.readers import nulls_for_nan

CUSTOMER_TABLES = ("customer", "nation", "orders", "lineitem")

# Order headers by customer.
_HEADS = """
  SELECT o_custkey AS h_custkey,
    count_if(o_orderpriority = '1-URGENT') AS urgent_orders,
    count_if(o_orderstatus = 'P') AS pending_orders,
    max(o_totalprice) / nullif(min(o_totalprice), 0D) AS price_spread_ratio,
    count(DISTINCT o_orderpriority) AS priority_breadth
  FROM {orders} WHERE o_custkey IS NOT NULL GROUP BY o_custkey
"""

# Every line with its customer: the one pass over lines and the one join with
# their orders. The join is the same at every size, and adaptive execution splits an
# order that holds too many lines. What the join only passes on moves as two whole
# numbers. The low bits of part, supplier and cents fill the first one; flags, rates,
# the day and the high bits of all, mostly zeros that pack well, are the other. A line
# moves as it came if a value is null, out of range or would not come back the same to
# the last bit.
_PART, _SUPPLIER, _DAY, _FLAGS = "bigint(l_partkey)", "bigint(l_suppkey)", "bigint(unix_date(shipped))", "bigint(flags)"
_CENTS, _DISCOUNT, _TAX = (f"bigint(rint({x} * 100D))" for x in ("l_extendedprice", "l_discount", "l_tax"))
# Value, first of its bits that are meant and how many these are; from the lowest bit of the whole number on.
_LOW = ((_CENTS, 0, 24), (_SUPPLIER, 0, 16), (_PART, 0, 24))
_HIGH = (
    (_FLAGS, 0, 3), (_TAX, 0, 4), (_DISCOUNT, 0, 4), (_DAY, 0, 16), (_TAX, 4, 3), (_DISCOUNT, 4, 3),
    (_CENTS, 24, 13), (_SUPPLIER, 16, 8), (_PART, 24, 6),
)


def _packed(fields: tuple) -> str:
    places = [sum(n for _, _, n in fields[:i]) for i in range(len(fields))]
    return " | ".join(f"shiftleft(shiftright({x}, {first}) & {(1 << n) - 1}L, {place})" for (x, first, n), place in zip(fields, places))


def _unpacked(value: str) -> str:
    """The value that ``_packed`` spread over both whole numbers."""
    parts = []
    for name, fields in (("money", _LOW), ("terms", _HIGH)):
        for i, (x, first, n) in enumerate(fields):
            if x == value:
                place = sum(m for _, _, m in fields[:i])
                parts.append(f"shiftleft(shiftrightunsigned({name}, {place}) & {(1 << n) - 1}L, {first})")
    return f"({' | '.join(parts)})"


_HUNDREDTHS = "rint({0} * 100D) / 100D = {0} AND {0} BETWEEN 0 AND {1}"
_NARROW_LINES = f"""
  SELECT l_orderkey,
    IF(fits, {_packed(_LOW)}, NULL) AS money,
    IF(fits, {_packed(_HIGH)}, NULL) AS terms,
    IF(fits, NULL, struct(l_partkey, l_suppkey, shipped, flags, l_extendedprice, l_discount, l_tax)) AS whole
  FROM (
    SELECT *, l_partkey BETWEEN 0 AND 1073741823 AND l_suppkey BETWEEN 0 AND 16777215 AND unix_date(shipped) BETWEEN 0 AND 65535
      AND {_HUNDREDTHS.format("l_extendedprice", "1e9D")}
      AND {_HUNDREDTHS.format("l_discount", "1.27D")}
      AND {_HUNDREDTHS.format("l_tax", "1.27D")} AS fits
    FROM (
      SELECT l_orderkey, l_partkey, l_suppkey, to_date(l_shipdate) AS shipped,
        tinyint(IF(l_linestatus = 'F', 1, 0) + CASE l_returnflag WHEN 'N' THEN 2 WHEN 'R' THEN 4 ELSE 0 END) AS flags,
        l_extendedprice, l_discount, l_tax
      FROM {{lineitem}}
    )
  )
"""
_OWNED_LINES = f"""
  SELECT /*+ MERGE(l, o) */ o_custkey,
    nvl2(whole, whole.l_partkey, {_unpacked(_PART)}) AS l_partkey,
    nvl2(whole, whole.l_suppkey, {_unpacked(_SUPPLIER)}) AS l_suppkey,
    datediff(nvl2(whole, whole.shipped, date_from_unix_date(int({_unpacked(_DAY)}))), ordered) AS lag,
    tinyint(nvl2(whole, whole.flags, {_unpacked(_FLAGS)})) AS flags,
    nvl2(whole, whole.l_extendedprice, {_unpacked(_CENTS)} / 100D) AS l_extendedprice,
    nvl2(whole, whole.l_discount, {_unpacked(_DISCOUNT)} / 100D) AS l_discount,
    nvl2(whole, whole.l_tax, {_unpacked(_TAX)} / 100D) AS l_tax
  FROM ({_NARROW_LINES}) l JOIN (
    SELECT o_orderkey, o_custkey, to_date(o_orderdate) AS ordered FROM {{orders}} WHERE o_custkey IS NOT NULL
  ) o ON l_orderkey = o_orderkey
"""

# Prices are written in cents, which take half the bytes of doubles; others as they are.
_FITS = _HUNDREDTHS.format("l_extendedprice", "2e7D")
_IN_CENTS = f"IF({_FITS}, int(rint(l_extendedprice * 100D)), NULL) AS cents", f"IF({_FITS}, NULL, l_extendedprice) AS price"
_PRICE = "nvl2(cents, cents / 100D, price) AS l_extendedprice"

# Money and rates add up in whole units of their last decimal, so they come out
# the same in any order of the rows.
_TOTALS = """
  SELECT o_custkey AS t_custkey,
    count(*) AS lines,
    sum(lag) AS lag,
    count_if(flags & 1 > 0) AS filled,
    count_if(flags & 2 > 0) AS kept,
    count_if(flags & 4 > 0) AS returned,
    sum({whole:l_extendedprice}) / {unit} AS price,
    sum({whole:l_discount}) / {unit} AS discount,
    sum({whole:l_tax}) / {unit} AS tax
  FROM {lines} GROUP BY o_custkey
"""

# One set of keys each, so no row is copied to tell them apart. The keys of a busy
# customer are dealt into eight shares, so that tasks share them; only counts move
# again, one for every other customer.
_SHARE = "pmod(hash({key}), {{shares}})"
_DISTINCT = f"""
  SELECT o_custkey AS {{name}}_custkey, sum(n) AS {{name}} FROM (
    SELECT o_custkey, count(DISTINCT {{key}}) AS n FROM (
      SELECT o_custkey, {{key}} FROM {{{{lines}}}} DISTRIBUTE BY o_custkey, {_SHARE}
    ) GROUP BY o_custkey, {_SHARE}
  ) GROUP BY o_custkey
"""
_PARTS = _DISTINCT.format(name="parts", key="l_partkey")
_SUPPLIERS = _DISTINCT.format(name="suppliers", key="l_suppkey")

# The four aggregates arrive partitioned by customer, so only the customer
# table itself moves for the large joins.
_ENTITIES = f"""
WITH heads AS ({_HEADS}), totals AS ({_TOTALS}), parts AS ({_PARTS}), suppliers AS ({_SUPPLIERS})
SELECT c_custkey AS customer_key,
  c_name AS customer,
  c_mktsegment AS segment,
  n_name AS country,
  lag / lines AS ship_lag_days,
  100D * filled / lines AS fulfilled_pct,
  tax / lines AS avg_tax,
  100D * kept / lines AS kept_pct,
  urgent_orders,
  100D * returned / lines AS return_pct,
  100D * parts / lines AS part_diversity_pct,
  discount / lines AS avg_discount,
  price AS revenue,
  pending_orders,
  c_acctbal AS account_balance,
  price_spread_ratio,
  suppliers AS supplier_breadth,
  CASE WHEN c_acctbal > 0 THEN 1 WHEN c_acctbal IS NOT NULL THEN 0 END AS in_credit,
  priority_breadth
FROM {{customer}}
  LEFT JOIN totals ON c_custkey = t_custkey
  LEFT JOIN parts ON c_custkey = parts_custkey
  LEFT JOIN suppliers ON c_custkey = suppliers_custkey
  LEFT JOIN heads ON c_custkey = h_custkey
  LEFT JOIN {{nation}} ON c_nationkey = n_nationkey
WHERE c_custkey IS NOT NULL
"""


# A value in whole units of its last decimal; one with further decimals is an error.
_WHOLE = (
    "CASE WHEN abs({x} * {unit} - rint({x} * {unit})) <= 1e-6D + 1e-12D * abs({x} * {unit}) THEN bigint(rint({x} * {unit})) "
    "WHEN {x} IS NOT NULL THEN bigint(raise_error(concat('{x} ', {x}, ' has more than {decimals} decimals'))) END"
)


def _with_units(sql: str, decimals: int) -> str:
    whole = _WHOLE.replace("{unit}", num(10**decimals)).replace("{decimals}", str(decimals))
    return re.sub(r"\{whole:(\w+)\}", lambda found: whole.replace("{x}", found[1]), sql).replace("{unit}", num(10**decimals))


def _shares(lines: DataFrame) -> str:
    """Into how many shares a customer's keys are dealt: eight for customers with a thousandth of all lines or more.

    A sketch finds them, 100 at most. Whom it names or misses changes who does the work, not what comes out.
    """
    found = lines.selectExpr("count(*) AS lines", "approx_top_k(o_custkey, 100, 10000) AS top").first()
    busy = sorted(r["item"] for r in found["top"] or () if 1000 * r["count"] >= found["lines"])
    return f"IF(o_custkey IN ({', '.join(map(str, busy))}), 8, 1)" if busy else "1"


def customer_entities(
    customer: DataFrame, nation: DataFrame, orders: DataFrame, lineitem: DataFrame, decimals: int = 2
) -> DataFrame:
    """One row per customer: identity columns and the fifteen metrics.

    A customer without orders keeps a row, its order metrics null. Prices,
    discounts and taxes add up at ``decimals`` places; a value that has more raises.
    """
    spark = customer.sparkSession
    # Read a few times, some columns each, and never joined again.
    owned = spark.sql(_OWNED_LINES, orders=orders, lineitem=lineitem)
    others = [c for c in owned.columns if c != "l_extendedprice"]
    lines = stage(owned.selectExpr(*others, *_IN_CENTS), "owned-lines").selectExpr(*others, _PRICE)
    entities = _with_units(_ENTITIES, decimals).replace("{shares}", _shares(lines))
    return spark.sql(entities, customer=customer, nation=nation, orders=orders, lines=lines)


def read_customer_entities(spark: SparkSession, folder: str) -> DataFrame:
    """The customer entity table from the parquet files of a star-schema folder."""
    tables = [spark.read.parquet(f"{folder}/{t}.parquet") for t in CUSTOMER_TABLES]
    return customer_entities(*map(nulls_for_nan, tables))
