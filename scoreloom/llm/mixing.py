"""Mixing sources to target weights by pivotal dependent rounding, in SQL functions only.

Every source gets a share of the words by its weight. A document's expected
number of copies is its source's target over its source's size: a whole part,
and a fraction to round. Rounding goes in pairs: words move between two
documents, one way or the other by a keyed coin that keeps both expectations,
until one of them has a whole number of copies. The words of a source add up to
the same all along, so a source misses its target by one document at most.

Pairs meet in a reduction tree: documents are dealt into blocks of a source by
hash, a block folds its own, and the one fraction it may leave goes up to a
block of blocks. A hot source merely has more blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.numbering import numbered, repeated_rows
from scoreloom.llm.text_sql import let, words
from scoreloom.operators.rank import with_position
from scoreloom.plans.staging import stage

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150  # of all words
CAP = 2  # copies of a document, and times a source's words
BLOCK = 64
SEED = 20240229

_EMPTY = "CAST(array() AS array<struct<doc_id: bigint, txt: bigint, copy: bigint, size: bigint, take: int>>)"
_COIN = f"shiftrightunsigned(xxhash64({SEED}, {{}}), 11) * 1.1102230246251565E-16D"
# What can move to the first and to the second document before one is whole.
_MOVES = "struct(least((1D - a.p) * a.size, b.p * b.size) AS up, least(a.p * a.size, (1D - b.p) * b.size) AS down)"
_AFTER = f"""CASE WHEN {_COIN.format('a.doc_id, a.txt, a.copy, b.doc_id, b.txt, b.copy')} * (m.up + m.down) < m.down
  THEN struct(CASE WHEN m.up = (1D - a.p) * a.size THEN 1D ELSE a.p + m.up / a.size END AS p,
              CASE WHEN m.up = b.p * b.size THEN 0D ELSE b.p - m.up / b.size END AS q)
  ELSE struct(CASE WHEN m.down = a.p * a.size THEN 0D ELSE a.p - m.down / a.size END AS p,
              CASE WHEN m.down = (1D - b.p) * b.size THEN 1D ELSE b.p + m.down / b.size END AS q) END"""


def _done(p: str) -> str:
    return f"({p} <= 0D OR {p} >= 1D)"


def _sealed(who: str, p: str) -> str:
    return f"array(struct({who}.doc_id AS doc_id, {who}.txt AS txt, {who}.copy AS copy, {who}.size AS size, int({p} >= 1D) AS take))"


def _state(who: str, p: str, out: str) -> str:
    return f"struct({who}.doc_id AS doc_id, {who}.txt AS txt, {who}.copy AS copy, {who}.size AS size, {p} AS p, {out} AS done)"


_NEXT = f"""CASE
  WHEN {_done('t.p')} AND {_done('t.q')} THEN
    struct(CAST(NULL AS bigint) AS doc_id, CAST(NULL AS bigint) AS txt, CAST(NULL AS bigint) AS copy, CAST(NULL AS bigint) AS size, CAST(NULL AS double) AS p,
           concat(a.done, {_sealed('a', 't.p')}, {_sealed('b', 't.q')}) AS done)
  WHEN {_done('t.p')} THEN {_state('b', 't.q', f"concat(a.done, {_sealed('a', 't.p')})")}
  ELSE {_state('a', 't.p', f"concat(a.done, {_sealed('b', 't.q')})")} END"""
_FOLD = f"""aggregate(items,
  struct(CAST(NULL AS bigint) AS doc_id, CAST(NULL AS bigint) AS txt, CAST(NULL AS bigint) AS copy, CAST(NULL AS bigint) AS size, CAST(NULL AS double) AS p, {_EMPTY} AS done),
  (a, b) -> CASE WHEN a.p IS NULL THEN {_state('b', 'b.p', 'a.done')} ELSE {let(_MOVES, 'm', let(_AFTER, 't', _NEXT))} END)"""


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, rows, target``: shares by weight, none above ``CAP`` times the source.

    Sources stand in order of code points, null last; the weights repeat. What a
    capped source cannot take goes to the others by weight, round by round, each
    round one sum over the sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    listed = ", ".join(map(str, WEIGHTS))
    sources = stage(
        with_position(totals, [F.asc_nulls_last("source")], "place").selectExpr(
            "source", "source_size", "rows", f"element_at(array({listed}), int((place - 1) % {len(WEIGHTS)}) + 1) AS weight"
        ),
        "sources",
    )
    want = SHARE_PERCENT * (sources.agg(F.sum("source_size")).first()[0] or 0)  # hundredths of a word
    rate, held = 0.0, -1
    while True:
        capped = f"{rate!r}D * weight > {CAP} * source_size" if held >= 0 else "source_size = 0"
        n, words_held, weight = sources.selectExpr(
            f"count_if({capped})", f"coalesce(sum(CASE WHEN {capped} THEN source_size END), 0)", f"coalesce(sum(CASE WHEN NOT {capped} THEN weight END), 0)"
        ).first()
        if n == held or not weight:
            break
        held, rate = n, (want - 100 * CAP * words_held) / (100 * weight)
    return sources.selectExpr("source", "source_size", "rows", f"least({rate!r}D * weight, double({CAP} * source_size)) AS target")


def document_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, txt, size``: the hash of the text and the words of every row."""
    return docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text", "CAST(source AS string) AS source").selectExpr(
        "doc_id", "source", "xxhash64(text) AS txt", f"bigint(size({words('text')})) AS size"
    )


def mixed_copies(docs: DataFrame) -> DataFrame:
    """How many copies of every document the mix takes.

    ``doc_id, txt, copy, source, size, source_size, target, copies, taken`` for
    each row of ``docs (doc_id, text, source)``; ``txt`` is the hash of the text,
    and ``copy`` numbers rows equal in doc_id, source and text. A null
    text has no words and takes none; a null source stands last. Coins are
    keyed by document and text, so reruns agree whatever the partitions. Other
    columns are ignored; an empty table gives no rows.
    """
    sizes = stage(document_sizes(docs), "sizes")
    targets = stage(source_targets(sizes), "targets")
    equal = sizes.groupBy("doc_id", "source", "txt", "size").agg(F.count(F.lit(1)).alias("n"))
    each = repeated_rows(equal, "n", "at").withColumn("copy", F.col("at") + 1)
    sized = each.alias("e").join(targets.alias("t"), F.col("e.source").eqNullSafe(F.col("t.source"))).selectExpr(
        "e.doc_id", "txt", "copy", "e.source", "size", "source_size", "target",
        "int(floor(target / greatest(source_size, 1))) AS whole",
        "target / greatest(source_size, 1) - floor(target / greatest(source_size, 1)) AS p",
        f"bigint(pmod(xxhash64({SEED + 1}, e.doc_id, txt, copy, size), bigint(ceil(rows / {BLOCK})))) AS block",
    )
    sized = stage(sized, "sized")
    settled = sized.where("size = 0 OR p = 0").selectExpr("doc_id", "txt", "copy", "source", "size", "source_size", "target", "whole", "0 AS take")
    parts, level = [settled], sized.where("size > 0 AND p > 0")
    blocks = -(-(targets.agg(F.max("rows")).first()[0] or 0) // BLOCK)
    while True:
        order = f"array_sort(collect_list(struct(xxhash64({SEED + 2}, doc_id, txt, copy) AS at, doc_id, txt, copy, size, p)))"  # about BLOCK rows
        folded = stage(
            level.groupBy("source", "block", "source_size", "target", "whole").agg(F.expr(order).alias("items"))
            .selectExpr("source", "block", "source_size", "target", "whole", f"{_FOLD} AS f"),
            "folded",
        )
        same = ["source", "source_size", "target", "whole"]
        parts.append(folded.selectExpr(*same, "inline(f.done)").select("doc_id", "txt", "copy", "source", "size", "source_size", "target", "whole", "take"))
        rest = folded.where("f.p IS NOT NULL").selectExpr("f.doc_id", "f.txt", "f.copy", "f.size", "f.p", *same, f"block div {BLOCK} AS block")
        if blocks <= 1:
            coin = _COIN.format("doc_id, txt, copy, size")
            parts.append(rest.selectExpr("doc_id", "txt", "copy", "source", "size", "source_size", "target", "whole", f"int({coin} < p) AS take"))
            break
        level, blocks = rest, -(-blocks // BLOCK)
    every = reduce(DataFrame.union, parts)
    return every.selectExpr("doc_id", "txt", "copy", "source", "size", "source_size", "target", "whole + take AS copies", "(whole + take) * size AS taken")


def _numbered(marked: DataFrame, repeated: DataFrame, columns: list[str]) -> DataFrame:
    """``marked`` with ``__copy``: the number of a row among those of its doc_id, source and text."""
    if repeated.isEmpty():
        return marked.withColumn("__copy", F.lit(1).cast("long"))
    key = ["__did", "__src", "__txt"]
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(r)) for k, r in zip(key, ("__id", "__source", "__t"))))
    others = F.to_json(F.struct(*[f"`{c}`" for c in columns]))
    copies = numbered(marked.join(repeated, same, "left_semi"), key, [F.xxhash64(others), others], "__number")
    copies = copies.withColumn("__copy", F.col("__number") + 1).drop("__number")
    return marked.join(repeated, same, "left_anti").withColumn("__copy", F.lit(1).cast("long")).unionByName(copies)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with every column.

    A document without words is never taken. Every row counts by itself: rows
    that agree in doc_id, source and text are numbered, in the order of their
    other columns' hash, and each is taken as often as its number.
    """
    copies = stage(
        mixed_copies(docs).where("size > 0 AND (copies > 0 OR copy = 2)")
        .selectExpr("doc_id AS __id", "source AS __source", "txt AS __t", "copy AS __c", "copies AS __n"),
        "copies",
    )
    marked = docs.selectExpr("*", "CAST(doc_id AS bigint) AS __did", "CAST(source AS string) AS __src", "xxhash64(CAST(text AS string)) AS __txt")
    numbered = _numbered(marked, copies.where("__c = 2").select("__id", "__source", "__t"), docs.columns)
    same = (
        F.col("__did").eqNullSafe(F.col("__id"))
        & F.col("__src").eqNullSafe(F.col("__source"))
        & (F.col("__txt") == F.col("__t"))
        & (F.col("__copy") == F.col("__c"))
    )
    # One plan at every size: both sides meet by document.
    taken = numbered.join(copies.where("__n > 0").hint("merge"), same).withColumn("__k", F.expr("explode(sequence(1, __n))"))
    return taken.select(*[f"`{c}`" for c in docs.columns])
