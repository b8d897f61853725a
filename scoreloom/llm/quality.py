"""Quality rules by cross-document line frequency, in SQL functions only.

Rules on the text itself come first: length, and words in repeated 8-word
windows. They need no shuffle. Then the lines of every host are counted by
distinct documents. A line that more than ``max_docs`` documents of a host share
is page furniture there: it is taken off every document but the one with the
smallest doc_id, so that a passage never vanishes altogether. A document that
loses most of its words this way is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.text_sql import let, normalised_lines, words
from scoreloom.plans.staging import stage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_DOCS = 20  # of a host, that may share a line
MIN_LEFT_PERCENT = 50  # of the words, after the shared lines are gone
# What tells rows of one doc_id apart; a hash alone would skip nulls, whichever column they are in.
ROW = "xxhash64(text IS NULL, text, source IS NULL, source)"

# Places of windows found twice or more, in order; then the words they cover.
_SORTED = "array_sort(transform(wins, (h, i) -> struct(h, i)))"
_TWICE = "array_sort(filter(transform(s, (x, j) -> CASE WHEN x.h = get(s, j - 1).h OR x.h = get(s, j + 1).h THEN x.i END), x -> x IS NOT NULL))"
_COVERED = f"aggregate(transform(p, (x, j) -> least({WINDOW}, coalesce(get(p, j + 1) - x, {WINDOW}))), 0L, (a, x) -> a + x)"
_REPEATED = let(_SORTED, "s", let(_TWICE, "p", _COVERED))
# Lines with a word that equal an earlier one.
_OWN_LINES = r"filter(split(text, '\\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"


def _cast(sql: str) -> str:
    return sql.replace("text, ", "CAST(text AS string), ").replace("source)", "CAST(source AS string))")


def _lines_key(line: str) -> str:
    """A line within its host, as two hashes; a null host is a host of its own."""
    host = "coalesce(concat('h', source), 'n')"
    return f"struct(xxhash64({host}, {line}) AS h, hash({line}, {host}) AS g, size(split({line}, ' ')) AS n)"


def text_rules(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, an identity (``did, rid``), the base counts, ``base_failed`` and the line keys."""
    named = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text", "CAST(source AS string) AS source")
    split = named.selectExpr(
        "doc_id",
        "coalesce(doc_id, -9223372036854775808) AS did",
        f"{ROW} AS rid",
        f"{words('text')} AS words",
        "coalesce(bigint(regexp_count(text, '[#*$%&|<>]')), 0L) AS n_symbols",
        "coalesce(" + let(_OWN_LINES, "l", "bigint(size(l) - size(array_distinct(l)))") + ", 0L) AS n_dup_lines",
        "coalesce(" + let(normalised_lines("text"), "l", f"transform(l, x -> {_lines_key('x')})") + ", array()) AS lines",
    )
    hashed = let(
        "transform(words, w -> xxhash64(w))",
        "f",
        f"CASE WHEN size(f) > {WINDOW} THEN transform(sequence(1, size(f) - {WINDOW - 1}), i -> xxhash64(slice(f, i, {WINDOW}))) END",
    )
    counted = split.selectExpr(
        "doc_id", "did", "rid", "lines", "n_symbols", "n_dup_lines",
        "bigint(size(words)) AS n_words",
        "bigint(length(array_join(words, ''))) AS word_chars",
        let(hashed, "w", f"CASE WHEN size(array_distinct(w)) < size(w) THEN {_REPEATED.replace('wins', 'w')} ELSE 0L END") + " AS n_repeat_words",
    )
    return counted.selectExpr(
        "*", f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed"
    )


def _common_lines(rules: DataFrame, max_docs: int) -> DataFrame:
    """Every line that is taken off a document: ``did, rid, h, g`` and the words that go."""
    once = rules.select("did", "rid", "lines").dropDuplicates(["did", "rid"])
    lines = stage(
        once.selectExpr("did", "rid", "inline(lines)").groupBy("h", "g", "did", "rid").agg(F.sum("n").alias("n")),
        "lines",
    )
    # Documents, not rows: one more step only where a doc_id has several texts.
    common = (
        lines.groupBy("h", "g", "did").agg(F.lit(1).alias("one"))
        .groupBy("h", "g").agg(F.count(F.lit(1)).alias("docs"), F.min("did").alias("keeper"))
        .where(F.col("docs") > max_docs)
        .select("h", "g", "keeper")
    )
    return lines.join(stage(common, "common"), ["h", "g"]).where("did <> keeper").select("did", "rid", "h", "g", "n")


def quality_verdicts(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """One row per row of ``docs (doc_id, text, source)``: the base counts and ``kept``.

    A null text has no words and fails. A null source is a host of its own. A
    null doc_id counts as one document, before all others. Equal rows get equal
    results. Other columns are ignored; an empty table gives no rows.
    """
    rules = stage(text_rules(docs), "rules")
    gone = _common_lines(rules, max_docs).groupBy("did", "rid").agg(F.sum("n").alias("gone"))
    left = "n_words - coalesce(gone, 0)"
    return (
        rules.drop("lines").join(gone, ["did", "rid"], "left")
        .selectExpr(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            "coalesce(gone, 0L) AS n_removed_words",
            f"NOT base_failed AND {left} >= {MIN_WORDS} AND 100 * ({left}) >= {MIN_LEFT_PERCENT} * n_words AS kept",
        )
    )


def clean_documents(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The documents that pass, with every column, their shared lines taken off the text."""
    rules = stage(text_rules(docs), "rules")
    gone = (
        _common_lines(rules, max_docs)
        .groupBy("did", "rid")
        .agg(F.sum("n").alias("__gone"), F.collect_list(F.struct("h", "g")).alias("__lines"))  # lines of one document
    )
    left = "n_words - coalesce(__gone, 0)"
    kept = (
        rules.select("did", "rid", "n_words", "base_failed").dropDuplicates(["did", "rid"])
        .join(gone, ["did", "rid"], "left")
        .where(f"NOT base_failed AND {left} >= {MIN_WORDS} AND 100 * ({left}) >= {MIN_LEFT_PERCENT} * n_words")
        .selectExpr("did AS __did", "rid AS __rid", "__lines")
    )
    own = "lower(regexp_replace(l, '[\\\\x20\\\\x09\\\\x0B-\\\\x0D]+', ' '))"
    key = _lines_key("x").replace("source", "CAST(source AS string)")
    keep = let(f"trim({own})", "x", f"x = '' OR NOT array_contains(__lines, {let(key, 'k', 'struct(k.h AS h, k.g AS g)')})")
    text = f"CASE WHEN __lines IS NULL THEN text ELSE array_join(filter(split(text, '\\n'), l -> {keep}), '\\n') END"
    marked = docs.selectExpr("*", "coalesce(CAST(doc_id AS bigint), -9223372036854775808) AS __did", f"{_cast(ROW)} AS __rid")
    columns = [f"{text} AS text" if c == "text" else f"`{c}`" for c in docs.columns]
    return marked.join(kept, ["__did", "__rid"]).selectExpr(*columns)
