"""Similarity join of documents on word n-grams, by vertical partitioning.

All n-grams stand in one global order, rarest first, and every document keeps
its n-grams as a set in that order.

1. Documents with equal sets form a class; one text speaks for each class.
2. Of a set of n n-grams the first n - ceil(t n) + 1 must meet those of any
   similar set, so only these prefixes are dealt into buckets by n-gram. The
   order comes from a count sketch of fixed size; it decides how much work
   there is, never the result, as any global order is exact. Most n-grams of
   a prefix stand in no other one, so they move once, packed, and what stands
   alone is dropped where it arrives.
3. The order is cut into fragments. A pair's overlap is counted in every
   fragment apart, and the partial counts are summed per pair.

Pairs inside a large bucket are never listed. The first pass compares the
documents of small buckets with one another, counting the buckets that a pair
shares, and those of large buckets with the least one; links merge. What is left
are large buckets that still hold several components. Their documents are cut
into blocks, and a task counts the overlaps of two blocks as matrix products,
fragment by fragment; only links leave it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.components import components
from scoreloom.llm.words import mix, shingle_sets, text_slices
from scoreloom.operators.rank import with_position
from scoreloom.plans.staging import release, stage

SKETCH_BITS = 22  # 4,194,304 counters: a broadcast of 4 MB at any size of the input
SKETCH_PARTS = 64
STEPS = 256  # of commonness, that the counters are told apart by
FAN_IN = 32  # sketches added up by one task
FRAGMENTS = 8  # of the global order, for counting pair by pair
BLOCK = 256  # classes of a block
SMALL_BUCKET = 32  # rows of a bucket that gives its pairs one by one
DEALT = 1 << 18  # places packed together, and of one group of buckets
LEAST_GROUPS = 64
SEEN = 20_000  # rows that a task remembers, to leave out equal ones
GRAM_BITS = 48  # of an n-gram as a bucket's name; n-grams that share them share a bucket
MARK_BITS, MARK_PART_BITS = 24, 6
WIDTH = 1 << 14  # n-grams of a fragment inside a block task
_U = np.uint64
PROFILE = ["doc_id", "txt", "n", "key", "task", "part", "counts"]


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, _long(np.concatenate([*sets, np.zeros(0, _U)])))


def _set_keys(sets: list[np.ndarray]) -> list[bytes]:
    from hashlib import blake2b

    return [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]


def _packed(counts: np.ndarray) -> bytes:
    """Counters, each of as many bytes as the largest takes."""
    small = counts.astype(np.min_scalar_type(int(counts.max())))
    return small.dtype.char.encode() + zlib.compress(small.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed[1:]), packed[:1].decode()).astype(np.uint64)


def _profiles(k: int):
    """A row for each document, and the task's share of the count sketch."""
    part = (1 << SKETCH_BITS) // SKETCH_PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(2)):
                sets = shingle_sets(texts, k)
                # Not as many numbers as there are counters: a worker keeps what it once took.
                slot, times = np.unique(np.concatenate(sets) >> _U(64 - SKETCH_BITS), return_counts=True)
                counts[slot] += times.astype(np.uint32)
                none = pa.nulls(b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(a, b - a) for i in (0, 1)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(_set_keys(sets), pa.binary()),
                        *(none.cast(t) for t in (pa.int32(), pa.int32(), pa.binary())),
                    ],
                    names=PROFILE,
                )
        if counts.any():
            cut = [_packed(c) for c in counts.reshape(SKETCH_PARTS, part)]
            none, task = pa.nulls(SKETCH_PARTS), TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    *(none.cast(t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())),
                    pa.array([task] * SKETCH_PARTS, pa.int32()),
                    pa.array(range(SKETCH_PARTS), pa.int32()),
                    pa.array(cut, pa.binary()),
                ],
                names=PROFILE,
            )

    return run


def _added(sketches: pd.DataFrame) -> pd.DataFrame:
    """Sketches of one part, ``FAN_IN`` at most, as one."""
    total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.uint64)
    for packed in sketches["counts"]:
        total += _unpacked(packed)
    return pd.DataFrame({"task": [sketches["task"].iloc[0] // FAN_IN], "part": [sketches["part"].iloc[0]], "counts": [_packed(total)]})


def _order(profile: DataFrame) -> np.ndarray:
    """How common the n-grams of each sketch counter are, in ``STEPS`` steps; always 4 MB.

    A step has about as many counters as any other. On a large input every counter
    holds hundreds of n-grams, and a common one tells by little more than their
    spread; powers of two would not tell it, and prefixes would be full of n-grams
    that unrelated texts share. The tasks' sketches are added in a tree: no task
    holds more than ``FAN_IN`` pieces of one part.
    """
    level = profile.where("part IS NOT NULL").select("task", "part", "counts")
    tasks = (level.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > 1:
        level = level.groupBy(F.expr(f"task div {FAN_IN}"), "part").applyInPandas(_added, "task int, part int, counts binary")
        tasks = -(-tasks // FAN_IN)
    totals = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.float32)
    for _, part, packed in level.collect():  # SKETCH_PARTS rows of fixed size
        totals[part] = _unpacked(packed)
    return _steps(totals.reshape(-1))


def _steps(totals: np.ndarray) -> np.ndarray:
    found = np.sort(totals[totals > 0])
    edges = np.unique(found[np.arange(1, STEPS) * len(found) // STEPS]) if len(found) else found
    steps = np.zeros(len(totals), np.uint8)
    for at in range(0, len(totals), DEALT):  # a few MB at a time
        steps[at : at + DEALT] = np.searchsorted(edges, totals[at : at + DEALT])
    return steps


def _ordered(grams: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """A set in the global order: by commonness, then by hash."""
    return grams[np.lexsort((grams, steps[(grams >> _U(64 - SKETCH_BITS)).astype(np.int64)]))]


def _prefixes(k: int, percent: int, steps):
    """The prefix of every text, its length and its last n-gram; of equal rows of a task the first speaks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            batch = _unseen(batch, seen)
            for a, b, texts in text_slices(batch.column(2)):
                sets = shingle_sets(texts, k)
                # Sets of so few n-grams are similar only when equal, which classes settle.
                lengths = [len(s) - -(-percent * len(s) // 100) + 1 if (100 - percent) * len(s) >= percent or (100 - percent) * (len(s) + 1) >= 100 else 0 for s in sets]
                firsts = [_ordered(s, steps.value)[:n] for s, n in zip(sets, lengths)]
                tails = np.array([f[-1] if len(f) else 0 for f in firsts], _U)
                step = steps.value[(tails >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(a, b - a) for i in (0, 1)),
                        pa.array(_set_keys(sets), pa.binary()),
                        _lists(firsts),
                        pa.array([len(f) for f in firsts], pa.int32()),
                        pa.array(step.astype(np.int32)),
                        pa.array(_long(tails ^ _U(1 << 63))),  # signed, in the order of the unsigned hashes
                    ],
                    names=["doc_id", "txt", "key", "prefix", "m", "step", "tail"],
                )

    return run


def _unseen(batch: pa.RecordBatch, seen: set) -> pa.RecordBatch:
    """Without rows whose ``doc_id, txt`` (the first two columns) one of the last rows has; later joins bear with others."""
    if len(seen) > SEEN:
        seen.clear()
    rows, new = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), []
    for row in rows:
        new.append(row not in seen)
        seen.add(row)
    return batch if all(new) else batch.filter(pa.array(new))


_PLACE = (np.uint64, np.int64, np.uint32, np.uint32)  # gram, id, n, pos


def _columns_packed(columns: list[np.ndarray]) -> bytes:
    """Places in the order of their grams: differences of these, and all numbers byte by byte."""
    columns = [np.diff(columns[0], prepend=_U(0)), *columns[1:]]
    return zlib.compress(b"".join(c.astype(t).view(np.uint8).reshape(len(c), -1).T.tobytes() for c, t in zip(columns, _PLACE)), 1)


def _columns_unpacked(packed: bytes) -> list[np.ndarray]:
    data, out, at = np.frombuffer(zlib.decompress(packed), np.uint8), [], 0
    rows = len(data) // sum(np.dtype(t).itemsize for t in _PLACE)
    for kind in _PLACE:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + rows * width].reshape(width, rows).T).view(kind).reshape(-1))
        at += rows * width
    return [np.cumsum(out[0], dtype=_U), *out[1:]]


def _runs(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the runs of equal values."""
    begins = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return begins, np.diff(np.append(begins, len(grams)))


def _dealt(groups: int):
    """Places of the n-grams of ``id, n, prefix``, packed by groups of buckets.

    Of an n-gram that one pack has more than ``SMALL_BUCKET`` times, the group gets
    one mark (id -1): its bucket is large anyway. Those places go to groups below 0,
    by pack, so that no group gathers a hot n-gram.
    """
    width = (1 << GRAM_BITS) // groups + 1

    def packs(columns: list[np.ndarray], salt: int) -> pa.RecordBatch:
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        begins, lengths = _runs(columns[0])
        hot = np.repeat(lengths > SMALL_BUCKET, lengths)
        out = [(-1 - salt % groups, [c[hot] for c in columns])] if hot.any() else []
        marks = begins[lengths > SMALL_BUCKET]
        columns[1][marks] = -1
        hot[marks] = False
        columns = [c[~hot] for c in columns]
        group = (columns[0] // _U(width)).astype(np.int64)
        begins, lengths = _runs(group)
        out += [(group[b], [c[b : b + n] for c in columns]) for b, n in zip(begins.tolist(), lengths.tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array([g for g, _ in out], pa.int32()), pa.array([_columns_packed(c) for _, c in out], pa.binary())], names=["group", "places"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, salt = [], 0, TaskContext.get().partitionId()
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy()
            ends = np.cumsum(lengths)
            grams, at = batch.column(2).flatten().to_numpy().view(_U), 0
            while at < len(grams):  # a pack at a time, so memory does not follow the batch
                spots = np.arange(at, min(at + DEALT - size, len(grams)))
                rows = np.searchsorted(ends, spots, side="right")
                ids, n = (batch.column(i).to_numpy()[rows] for i in (0, 1))
                held.append([mix(grams[spots]) >> _U(64 - GRAM_BITS), ids, n, spots - (ends - lengths)[rows]])
                at, size = at + len(spots), size + len(spots)
                if size == DEALT:
                    yield packs([np.concatenate(c) for c in zip(*held)], salt)
                    held, size, salt = [], 0, salt + 1
        if size:
            yield packs([np.concatenate(c) for c in zip(*held)], salt)

    return run


def _met(packs: pa.Table) -> pa.Table:
    """The places of n-grams that have another one, and whether their bucket is large."""
    gram, ids, n, pos = (np.concatenate(c) for c in zip(*map(_columns_unpacked, packs["places"].to_pylist())))
    if packs["group"][0].as_py() < 0:
        crowd = stays = np.ones(len(gram), bool)
    else:
        order = np.argsort(gram, kind="stable")
        gram, ids, n, pos = gram[order], ids[order], n[order], pos[order]
        begins, lengths = _runs(gram)
        rows = np.repeat(np.add.reduceat(np.where(ids < 0, SMALL_BUCKET + 1, 1), begins), lengths)
        crowd, stays = rows > SMALL_BUCKET, (rows > 1) & (ids >= 0)
    return pa.table({"gram": _long(gram[stays]), "id": ids[stays], "n": n[stays].astype(np.int64), "pos": pos[stays].astype(np.int32), "crowd": crowd[stays]})


_SLOT = f"pmod(xxhash64(doc_id, txt), {1 << MARK_BITS})"


def _bits(part: pd.DataFrame) -> pd.DataFrame:
    """The marks of one part: a bit for each of its slots."""
    marks = np.zeros(1 << (MARK_BITS - MARK_PART_BITS), bool)
    marks[part["slot"].to_numpy() % len(marks)] = True
    return pd.DataFrame({"part": [part["part"].iloc[0]], "bits": [np.packbits(marks, bitorder="little").tobytes()]})


def _mark_rows(texts: DataFrame) -> DataFrame:
    """A bit for the hash of every ``doc_id, txt``: 2 MB at any number of them, in 64 rows ``part, bits`` of fixed size at most."""
    slots = texts.selectExpr(f"{_SLOT} AS slot").distinct().selectExpr("slot", f"slot div {1 << (MARK_BITS - MARK_PART_BITS)} AS part")
    return slots.groupBy("part").applyInPandas(_bits, "part long, bits binary")


def _marked(spoken: DataFrame) -> np.ndarray:
    """The marks of the speakers as one array."""
    out = np.zeros(1 << (MARK_BITS - 3), np.uint8)
    size = len(out) >> MARK_PART_BITS
    for part, bits in _mark_rows(spoken).collect():
        out[part * size : (part + 1) * size] = np.frombuffer(bits, np.uint8)
    return out


def _marked_sets(k: int, marks, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Marked rows and the sets of their texts, equal rows of a task once; a few others share a mark and go in the next join."""
    seen = set()
    for batch in batches:
        slot = batch.column(3).to_numpy()
        batch = batch.filter(pa.array((marks.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))
        batch = _unseen(batch, seen)
        for a, b, texts in text_slices(batch.column(2)):
            yield batch.slice(a, b - a), shingle_sets(texts, k)


def _sets(k: int, marks):
    """The sets of marked texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _marked_sets(k, marks, batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(_set_keys(sets), pa.binary()), _lists(sets)], names=["doc_id", "txt", "key", "grams"]
            )

    return run


def _parts(k: int, marks):
    """The sets of marked texts, cut into ranges of the hash order; an empty part has no row."""
    edges = np.arange(1, FRAGMENTS, dtype=_U) << _U(64 - (FRAGMENTS - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _marked_sets(k, marks, batches):
            cut = [(key, f, part) for key, s in zip(_set_keys(sets), sets) for f, part in enumerate(np.split(s, np.searchsorted(s, edges))) if len(part)]
            if cut:
                keys, fragments, parts = zip(*cut)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(fragments, pa.int32()), _lists(list(parts))], names=["key", "fragment", "part"])

    return run


def _overlaps(left: pd.Series, right: pd.Series) -> np.ndarray:
    """How many n-grams each set of ``left`` shares with each of ``right``, summed over fragments of their common order."""
    total = np.zeros((len(left), len(right)), np.int64)
    if not total.size:  # a block of which nothing is left
        return total
    sides = [(np.concatenate(list(x)), np.repeat(np.arange(len(x)), [len(s) for s in x]), len(x)) for x in (left, right)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    if not len(shared):
        return total
    places = []
    for grams, rows, n in sides:
        at = np.minimum(np.searchsorted(shared, grams), len(shared) - 1)
        hit = shared[at] == grams
        places.append((at[hit], rows[hit], n))
    for start in range(0, len(shared), WIDTH):
        width, tables = min(WIDTH, len(shared) - start), []
        for at, rows, n in places:
            own = (at >= start) & (at < start + width)
            table = np.zeros((n, width), np.float32)
            table[rows[own], at[own] - start] = 1
            tables.append(table)
        total += np.rint(tables[0] @ tables[1].T).astype(np.int64)  # counts below 2**24 are exact
    return total


def _block_candidates(percent: int):
    """Documents of two blocks that, by their prefixes, may link with one of another component."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"p": [], "q": [], "id": []}, dtype=np.int64)
        n, m = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
        need = -(-percent * (n + m) // (100 + percent))
        least = need - _overlaps(left["prefix"], right["prefix"])
        order = [side["step"].to_numpy().astype(object) * (1 << 64) + side["tail"].to_numpy().astype(object) for side in (left, right)]
        ranks = np.searchsorted(np.sort(np.concatenate(order)), np.concatenate(order))
        earlier = ranks[: len(left)][:, None] <= ranks[len(left) :][None, :]
        rest = [side["n"].to_numpy() - side["prefix"].map(len).to_numpy() for side in (left, right)]
        may = (np.where(earlier, rest[0][:, None], rest[1][None, :]) >= least) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
        may &= left["c"].to_numpy()[:, None] != right["c"].to_numpy()[None, :]
        ids = np.unique(np.concatenate((left["id"].to_numpy()[may.any(1)], right["id"].to_numpy()[may.any(0)])))
        return pd.DataFrame({"p": np.full(len(ids), key[0], np.int64), "q": np.full(len(ids), key[1], np.int64), "id": ids})

    return run


def _block_links(percent: int):
    """Links between the documents of two blocks, one for each pair of components."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        overlap = _overlaps(left["grams"], right["grams"])
        union = left["n"].to_numpy()[:, None] + right["n"].to_numpy()[None, :] - overlap
        c, d = left["c"].to_numpy(), right["c"].to_numpy()
        a, b = np.nonzero((100 * overlap >= percent * union) & (c[:, None] != d[None, :]))
        return pd.DataFrame({"u": c[a], "v": d[b]}).drop_duplicates()

    return run


def _by_blocks(asked: DataFrame, kernel, schema: str) -> DataFrame:
    """``kernel`` over the rows of every pair of blocks ``(p, q)``; ``asked`` has a row for each pair that needs it, with its block."""
    columns = [c for c in asked.columns if c != "block"]
    left, right = asked.where("block = p").select(columns), asked.where("block = q").select(columns).toDF(*columns)
    return left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInPandas(kernel, schema)


def _may_link(percent: int, a: str, b: str) -> str:
    """SQL: the lengths and prefix places of two sets allow enough overlap."""
    need = f"ceil({percent} * ({a}.n + {b}.n) / {100 + percent})"
    most = f"1 + least({a}.n - {a}.pos, {b}.n - {b}.pos) - 1 + least({a}.pos, {b}.pos)"
    return f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n) AND {most} >= {need}"


def _near(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The ``pairs (a, b, common)`` whose prefixes share enough n-grams.

    Of two prefixes, the n-grams of the one that ends earlier in the order meet
    the other set only in the other prefix, so the overlap is at most what the
    prefixes share and what is left of that set. They share at most as many as
    they have small buckets in common, and large ones (``crowd``; a name that a
    document has twice counts twice).
    """
    x = facts.selectExpr("id AS a", "n AS na", "m AS ma", "step AS sa", "tail AS ta", "coalesce(crowd, array()) AS ca")
    y = facts.selectExpr("id AS b", "n AS nb", "m AS mb", "step AS sb", "tail AS tb", "coalesce(crowd, array()) AS cb")
    rest = "CASE WHEN struct(sa, ta) <= struct(sb, tb) THEN na - ma ELSE nb - mb END"
    large = "size(array_intersect(ca, cb)) + least(size(ca) - size(array_distinct(ca)), size(cb) - size(array_distinct(cb)))"
    return pairs.join(x, "a").join(y, "b").where(f"common + {large} + {rest} >= ceil({percent} * (na + nb) / {100 + percent})").select("a", "b")


def _linked(pairs: DataFrame, speakers: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The similar ones among ``pairs (a, b)``: overlaps counted by fragment, then summed.

    A class may have the same part more than once (from equal rows), so a pair has one overlap a fragment.
    """
    named = speakers.select("id", "n", "key")
    asked = pairs.join(named.toDF("a", "na", "ka"), "a").join(named.toDF("b", "nb", "kb"), "b")
    asked = asked.selectExpr("*", f"explode(sequence(0, {FRAGMENTS - 1})) AS fragment")
    partial = (
        asked.join(parts.toDF("ka", "fragment", "pa"), ["ka", "fragment"])
        .join(parts.toDF("kb", "fragment", "pb"), ["kb", "fragment"])
        .selectExpr("a", "b", "na", "nb", "fragment", "bigint(size(array_intersect(pa, pb))) AS overlap")
    )
    apart = [F.coalesce(F.max(F.when(F.col("fragment") == f, F.col("overlap"))), F.lit(0)).alias(f"o{f}") for f in range(FRAGMENTS)]
    overlap = " + ".join(f"o{f}" for f in range(FRAGMENTS))
    return partial.groupBy("a", "b", "na", "nb").agg(*apart).where(f"100 * ({overlap}) >= {percent} * (na + nb - ({overlap}))").select("a", "b")


def _identified(docs: DataFrame) -> DataFrame:
    """``doc_id, txt, text``: a text under its doc_id is what the join tells apart."""
    return docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "xxhash64(CAST(text AS string)) AS txt", "CAST(text AS string) AS text")


def _grouped(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every row's ``doc_id, txt, n, key``, and for every key its component's least doc_id and first text."""
    spark = docs.sparkSession
    source = _identified(docs)
    profile = stage(source.mapInArrow(_profiles(k), "doc_id long, txt long, n long, key binary, task int, part int, counts binary"), "profile")
    steps = spark.sparkContext.broadcast(_order(profile))

    one = profile.where("part IS NULL").select("doc_id", "txt", "n", "key")
    # Hot classes add up before the shuffle; the least row that has a doc_id speaks.
    heads = one.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.min(F.struct(F.isnull("doc_id").alias("bare"), "doc_id", "txt")).alias("rep"), F.first("n").alias("n"))
    # Written once: the numbers must not change any more.
    heads = stage(heads.withColumn("id", F.monotonically_increasing_id()), "classes")
    spoken = heads.selectExpr("id", "n", "key", "rep.doc_id AS doc_id", "rep.txt AS txt")

    def of_speakers(rows: DataFrame, speakers: DataFrame) -> DataFrame:
        """``rows (doc_id, txt, key, ...)`` of the texts that speak for a class, each once, under its id."""
        by = ["did", "bare", "txt", "key"]  # both the join and the duplicates, so rows move once
        a, b = (t.selectExpr("coalesce(doc_id, 0L) AS did", "doc_id IS NULL AS bare", "*").drop("doc_id") for t in (rows, speakers))
        return a.join(b, by).dropDuplicates(by).select("id", "n", *rows.columns[3:])

    prefixes = source.mapInArrow(_prefixes(k, percent, steps), "doc_id long, txt long, key binary, prefix array<long>, m int, step int, tail long").where("m > 0")
    prefixes = stage(of_speakers(prefixes, spoken), "prefixes")
    steps.destroy()
    places = prefixes.agg(F.sum("m")).first()[0] or 0
    packs = prefixes.select("id", "n", "prefix").mapInArrow(_dealt(max(LEAST_GROUPS, -(-places // DEALT))), "group int, places binary")
    shared = stage(packs.groupBy("group").applyInArrow(_met, "gram long, id long, n long, pos int, crowd boolean"), "shared")
    slotted = source.selectExpr("doc_id", "txt", "text", f"{_SLOT} AS slot")

    def marked(ids: DataFrame):
        speakers = stage(ids.join(spoken, "id"), "speakers")
        return speakers, spark.sparkContext.broadcast(_marked(speakers))

    # First pass: all pairs of small buckets, and every class against the least of each of its large buckets.
    crowd, small = shared.where("crowd"), shared.where("NOT crowd")
    lead = crowd.groupBy("gram").agg(F.min(F.struct("id", "pos", "n")).alias("l"))
    stars = crowd.alias("x").join(lead.selectExpr("gram", "l.*").alias("y"), "gram").where("x.id <> y.id").where(_may_link(percent, "x", "y")).selectExpr("y.id AS a", "x.id AS b", "0L AS common")
    few = small.alias("x").join(small.alias("y"), "gram").where("x.id < y.id").where(_may_link(percent, "x", "y")).selectExpr("x.id AS a", "y.id AS b", "1L AS common")
    facts = prefixes.select("id", "n", "m", "step", "tail").join(crowd.groupBy("id").agg(F.collect_list("gram").alias("crowd")), "id", "left")
    pairs = stage(_near(stars.union(few).groupBy("a", "b").agg(F.sum("common").alias("common")), facts, percent), "pairs")
    speakers, marks = marked(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    parts = slotted.mapInArrow(_parts(k, marks), "key binary, fragment int, part array<long>")
    found = stage(_linked(pairs, speakers, parts, percent).selectExpr("a AS u", "b AS v"), "links")
    marks.destroy()
    merged = stage(components(found), "first-components")
    release(pairs, speakers, found)

    # Second pass: large buckets that hold several components still.
    told = crowd.join(merged.withColumnRenamed("node", "id"), "id", "left").selectExpr("id", "gram", "coalesce(component, id) AS c")
    open_ = told.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("gram")
    large = stage(told.join(open_, "gram"), "open")
    release(shared)
    every = merged
    if not large.isEmpty():
        # Classes of one family mostly share their least bucket, so families lie together.
        anchors = large.groupBy("id", "c").agg(F.min("gram").alias("anchor"))
        placed = stage(
            with_position(anchors, [F.asc("anchor"), F.asc("id")], "place").selectExpr("id", "c", f"bigint((place - 1) div {BLOCK}) AS block"),
            "blocks",
        )
        spread = large.select("id", "gram").join(placed.select("id", "block"), "id").select("gram", "block").distinct()
        both = spread.alias("x").join(spread.alias("y"), "gram").where("x.block <= y.block").selectExpr("x.block AS p", "y.block AS q").distinct()
        both = stage(both, "block-pairs")
        held = placed.join(prefixes.drop("m"), "id")
        asked = both.join(held, both.p == held.block).unionByName(both.where("p < q").join(held, both.q == held.block))
        close = stage(_by_blocks(asked, _block_candidates(percent), "p long, q long, id long"), "close")
        speakers, marks = marked(close.select("id").distinct())
        sets = stage(of_speakers(slotted.mapInArrow(_sets(k, marks), "doc_id long, txt long, key binary, grams array<long>"), speakers), "sets")
        marks.destroy()
        # Sets go only where the prefixes of two blocks leave a link possible.
        more = stage(_by_blocks(close.join(placed, "id").join(sets, "id"), _block_links(percent), "u long, v long"), "block-links")
        every = stage(components(more.union(merged.selectExpr("node AS u", "component AS v"))), "components")
        release(speakers, sets, merged, placed, both, close, more)
    release(prefixes, large)

    placed = heads.join(every.withColumnRenamed("node", "id"), "id", "left").selectExpr("key", "least", "rep", "coalesce(component, id) AS component")
    firsts = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.min("rep").alias("first"))
    return one, placed.select("key", "component").join(firsts, "component").select("key", "component_id", "first")


def similar_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs (doc_id, text)``.

    Two texts link when 100 * overlap >= percent * union of their sets of
    ``k``-word shingles; a component is named by the least doc_id in it, null if
    none of its rows has one. Fewer than ``k`` words are one shingle; a text that
    is null or has no words has none, links with nothing and is a component of
    its own. Every row is looked at by its own text, those that repeat a doc_id
    or have none included. Other columns are ignored; an empty table gives no
    rows.
    """
    one, named = _grouped(docs, k, percent)
    return one.join(named, "key", "left").selectExpr(
        "doc_id", "n AS n_shingles", "CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id"
    )


def without_similar(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every component of similar texts: the least doc_id, of its texts the least hash.

    Of rows equal in doc_id and text one stays, the least as JSON. Texts without
    words all stay. A row with a doc_id goes before one without. Every column stays
    as it is.
    """
    one, named = _grouped(docs, k, percent)
    texts = one.where("n > 0").groupBy("doc_id", "txt", "key").agg(F.count(F.lit(1)).alias("rows"))
    told = texts.join(named, "key").selectExpr("doc_id AS __id", "txt AS __t", "rows", "first.doc_id <=> doc_id AND first.txt = txt AS stays")
    told = stage(told.where("NOT stays OR rows > 1"), "told")
    marked = docs.selectExpr("*", "CAST(doc_id AS bigint) AS __did", "xxhash64(CAST(text AS string)) AS __txt")
    # Most texts share no mark with one that goes: they stay where they are.
    marks = stage(_mark_rows(told.toDF("doc_id", "txt", "rows", "stays")), "marks").toDF("__part", "__bits")
    marked = marked.withColumn("__slot", F.expr(_SLOT.replace("doc_id", "__did").replace("txt", "__txt")))
    marked = marked.join(F.broadcast(marks), F.expr(f"__slot div {1 << (MARK_BITS - MARK_PART_BITS)} = __part"), "left")
    place = f"__slot % {1 << (MARK_BITS - MARK_PART_BITS)}"
    byte = f"int(conv(hex(substring(__bits, int({place} div 8) + 1, 1)), 16, 10))"
    marked = marked.withColumn("__mark", F.expr(f"coalesce(shiftright({byte}, int(__slot % 8)) & 1, 0) = 1"))
    same = F.col("__did").eqNullSafe(F.col("__id")) & (F.col("__txt") == F.col("__t"))
    columns = [f"`{c}`" for c in docs.columns]
    apart, marked = marked.where("NOT __mark").select(*columns), marked.where("__mark").select(*columns, "__did", "__txt")
    # One plan at every size: marked texts and what goes meet by document.
    kept = apart.unionByName(marked.join(told.hint("merge"), same, "left_anti").select(*columns))
    if told.where("stays").isEmpty():
        return kept
    whole = F.struct(*columns)
    again = marked.join(told.where("stays").hint("merge"), same, "left_semi").groupBy("__did", "__txt").agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return kept.unionByName(again.select("row.*"))
