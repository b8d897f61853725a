"""The doubled ranks of line runs against a suffix array that is sorted to its end."""

import random

from scoreloom.llm.line_dedup import repeated_runs


def whole_suffix_array(rows, least):
    """Runs ``(document, line, lines, first place)`` that stand before: every suffix, sorted over all its lines."""
    docs = {i: [line for line in text.split("\n") if line.split()] for i, text in rows}
    order = sorted((lines[at:], i, at) for i, lines in docs.items() for at in range(len(lines)))
    shared = []  # lines that a suffix has in common with the one before it
    for (a, *_), (b, *_) in zip(order, order[1:]):
        n = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        shared.append(n)
    found = set()
    for spot, (suffix, i, at) in enumerate(order):
        words, need = 0, 0
        while need < len(suffix) and words < least:
            words, need = words + len(suffix[need].split()), need + 1
        if words < least:
            continue
        low = high = spot
        while low and shared[low - 1] >= need:
            low -= 1
        while high < len(shared) and shared[high] >= need:
            high += 1
        first = min(order[s][1:] for s in range(low, high + 1))
        if first != (i, at):
            found.add((i, at, need, *first))
    return found


def test_runs_are_those_of_a_whole_suffix_array(spark):
    rng = random.Random(11)
    lines = [" ".join(f"{c}{i}" for i in range(rng.choice((1, 1, 2, 5, 12)))) for c in "abcdefghijkl"]
    blocks = [[rng.choice(lines) for _ in range(rng.randrange(30, 90))] for _ in range(4)]
    rows = []
    for i in range(30):
        text = [rng.choice(lines) for _ in range(rng.randrange(4))]
        for _ in range(rng.randrange(1, 4)):
            block = rng.choice(blocks)
            a = rng.randrange(len(block) // 2)
            text += block[a : a + rng.randrange(1, len(block))] + [f"alone {i} {rng.random()}"] * rng.randrange(2)
        rows.append((i, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (1, 7, 50):
        got = [(r.did, r.i, r.need, r.first.did, r.first.i) for r in repeated_runs(docs, least).collect()]
        assert len(got) == len(set(got)) and set(got) == whole_suffix_array(rows, least)
