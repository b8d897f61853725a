"""Spelling variants by permuterm rotations.

A word is marked at its end and turned: every rotation starts at another letter.
Two words that differ by one replaced letter have rotations that agree but for
their last letter, the replaced one; where one letter is missing, a whole
rotation of the shorter word is what the longer one's rotation shows before that
letter. So every word gives its whole rotations and those without their last
letter, all are sorted, and the rows of one prefix are scanned together.

A prefix tells the place of the edit, so a word stands in it once, and the group
has no more rows than there are letters: no group is large, however common a
word is. Each pair of near words meets once: a letter inside a run of equal ones
is left out only as the first of them. Near words are counted and compared inside
the scan; pairs are never listed.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.plans.staging import release, stage

END = "\u0000"  # no word holds it
TIMES = 10  # as common as the word a form must be
TASK_WORDS = 1 << 15  # words whose rotations one task makes
HELD_WORDS = 1 << 18  # counts a task holds before it hands them on
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lower_ascii(word: str) -> str:
    """A-Z in lower case, other letters as they are."""
    return word.lower() if word.isascii() else word.translate(_UPPER)


def without_a_letter(doc_id: int | None, word: str, every: int = 31) -> str:
    """``word`` without one letter where the crc32 of ``doc_id:word`` is divisible by ``every``."""
    mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if mark % every:
        return word
    at = mark % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, letters: str = r"A-Za-zÀ-ÿ", least: int = 7, change: Callable[[int | None, str], str] | None = None
) -> DataFrame:
    """``word, n``: how often each word of at least ``least`` letters occurs in ``docs (doc_id, text)``.

    Words are longest runs of ``letters``, with A-Z in lower case; ``change`` may
    replace a word by a shorter one, by document. Null and empty texts have no
    words; rows count one by one, equal ones too; a doc_id may be null.
    """
    find = re.compile(f"[{letters}]{{{least},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def held() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own: Counter[str] = Counter()
                for word, n in Counter(find(text.as_py() or "")).items():
                    own[lower_ascii(word)] += n
                for word, n in own.items():
                    word = change(doc_id, word) if change else word
                    if len(word) >= least:
                        total[word] += n
                if len(total) > HELD_WORDS:
                    yield held()
        yield held()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, letter, first, n``: all rotations of ``words (word, n)``.

    Whole ones have no ``letter``; the others stop before it. ``first`` says that
    no equal letter stands right before it in the word.
    """
    end = f"'\\u{ord(END):04X}'"
    skipped = (
        f"transform(sequence(1, length(word)), i -> struct(concat(substr(word, i + 1), {end}, substr(word, 1, i - 1)) AS prefix, "
        "substr(word, i, 1) AS letter, i = 1 OR substr(word, i, 1) <> substr(word, i - 1, 1) AS first))"
    )
    whole = (
        f"transform(sequence(0, length(word)), i -> struct(concat(substr(word, i + 1), {end}, substr(word, 1, i)) AS prefix, "
        "CAST(NULL AS string) AS letter, false AS first))"
    )
    return words.selectExpr("n", f"inline(concat({skipped}, {whole}))")


def _spelled(letter: Column) -> Column:
    """The word of a row: what stands after the mark, the letter, what stands before the mark."""
    return F.concat(F.substring_index("prefix", END, -1), F.coalesce(letter, F.lit("")), F.substring_index("prefix", END, 1))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best (n, form)`` for every word of ``words (word, n)`` that has near ones.

    Near words differ by one letter more, less or replaced; ``best`` is the most
    frequent of them, the least in code-point order among equals.
    """
    line = Window.partitionBy("prefix").orderBy(F.isnull("letter"), F.desc("n"), "letter")
    group = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct("letter", "n")
    opening = F.when(F.col("first"), F.struct((-F.col("n")).alias("minus"), "letter"))
    rows = rotations(words).select(
        "prefix",
        "letter",
        "first",
        "n",
        F.count("letter").over(group).alias("edited"),  # words that have a letter there
        F.count(opening).over(group).alias("openers"),
        F.first(me).over(group).alias("top"),
        F.nth_value(me, 2).over(group).alias("second"),
        F.last(me).over(group).alias("shorter"),  # the whole rotation, if there is one, is last
        F.min(opening).over(group).alias("opener"),
    )
    bare, has_shorter = F.isnull("letter"), F.isnull("shorter.letter")
    other = F.when(F.col("top.letter") == F.col("letter"), F.col("second")).otherwise(F.col("top"))
    replaced = F.when(~bare & (F.col("edited") > 1), F.struct((-other["n"]).alias("minus"), _spelled(other["letter"]).alias("form")))
    cut = F.when(~bare & F.col("first") & has_shorter, F.struct((-F.col("shorter.n")).alias("minus"), _spelled(F.lit(None)).alias("form")))
    longer = F.when(bare & (F.col("openers") > 0), F.struct(F.col("opener.minus").alias("minus"), _spelled(F.col("opener.letter")).alias("form")))
    near = F.when(bare, F.col("openers")).otherwise(F.col("edited") - 1 + F.when(F.col("first") & has_shorter, 1).otherwise(0))
    met = rows.select(_spelled(F.col("letter")).alias("word"), near.alias("near"), F.least(replaced, cut, longer).alias("best")).where("near > 0")
    return (
        met.groupBy("word")
        .agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
        .selectExpr("word", "n_near", "struct(-best.minus AS n, best.form AS form) AS best")
    )


def _roots(links: DataFrame) -> DataFrame:
    """``word, root``: where the forms of ``links (word, root)`` lead; counts grow tenfold, so chains are short."""
    now = stage(links, "roots")
    while True:
        far = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        then = stage(now.join(far, "root", "left").selectExpr("word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved"), "roots")
        release(now)
        if then.where("moved").isEmpty():
            return then.select("word", "root")
        now = then


def spelling_variants(words: DataFrame, least_n: int = 2, times: int = TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for the words of ``words (word, n)`` with ``n >= least_n``.

    ``form`` is a word's most frequent near word (see ``near_words``) if that is
    at least ``times`` as frequent, else null; ``root`` is where forms lead in
    the end, the word itself if it has none. Words are told apart exactly; null
    and empty words are left out, rows that repeat a word add up. A word that
    holds U+0000 raises. ``times`` is at least 2, so that forms never turn back.
    """
    if times < 2:
        raise ValueError("times must be at least 2")
    kept = words.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)
    proper = F.when(F.instr("word", END) > 0, F.raise_error(F.lit("a word holds U+0000"))).otherwise(F.col("word"))
    kept = stage(kept.select(proper.alias("word"), "n"), "words")
    # Words give twenty rotations each, so they are dealt out by number first.
    dealt = kept.repartition(max(1, -(-kept.count() // TASK_WORDS)), "word")
    near = kept.join(near_words(dealt), "word", "left")
    common = F.col("best.n") >= times * F.col("n")
    told = stage(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(common, F.col("best.form")).alias("form"),
            F.when(common, F.col("best.n")).alias("form_n"),
        ),
        "near-words",
    )
    release(kept)
    roots = _roots(told.where("form IS NOT NULL").selectExpr("word", "form AS root"))
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
