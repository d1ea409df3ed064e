"""Operators 5 and 7: DataFrame functions only."""

import random
from collections import defaultdict

import pytest
from corpus import docs, odd_texts, words
from pyspark.sql import functions as F

from pulsegrid.llm import lines, sharding


def plan(df):
    return df._jdf.queryExecution().toString()


def check_shards(rows, n, tolerance, biggest):
    by = defaultdict(list)
    for r in rows:
        by[r["shard_"]].append(r)
    for rs in by.values():
        assert sorted(r["slot_"] for r in rs) == list(range(len(rs)))
    total = sum(r["size_"] for r in rows)
    for k in range(n):
        assert abs(sum(r["size_"] for r in by[k]) - total / n) <= 2 * max(tolerance * total / n, biggest)


@pytest.mark.parametrize("slot_rows", [50_000, 7])
def test_shards_are_even(spark, slot_rows):
    rnd = random.Random(1)
    rows = [(k, words(rnd, rnd.randint(1, 60))) for k in range(900)]
    rows += [(1000 + k, "one very common text of some words") for k in range(450)]  # a hot text
    got = sharding.shard_by_bytes(docs(spark, rows, extra=True), 8, slot_rows=slot_rows)
    assert "Python" not in plan(got) and "Arrow" not in plan(got)
    check_shards(got.collect(), 8, sharding.TOLERANCE, max(len(t) + 8 for _, t in rows))


def test_equal_texts_share_a_shard_where_they_can(spark):
    rnd = random.Random(2)
    rows = [(i * 100 + k, t) for i in range(300) for t in [words(rnd, 20)] for k in range(3)]
    got = sharding.shard_by_bytes(docs(spark, rows), 4, tolerance=0.05).groupBy("text").agg(F.countDistinct("shard").alias("n"))
    assert got.filter("n > 1").count() == 0


def test_shards_of_odd_rows(spark):
    rows = [(k % 5 if k % 4 else None, t) for k, t in enumerate(odd_texts() * 2)]
    got = sharding.shard_by_bytes(docs(spark, rows, extra=True), 3).collect()
    assert len(got) == len(rows) and {r["shard_"] for r in got} <= {0, 1, 2}
    assert sorted(r["size_"] for r in got) == sorted(len((t or "").encode()) + 8 for _, t in rows)
    assert sharding.shard_by_bytes(docs(spark, []), 3).count() == 0
    same = sharding.shard_by_bytes(docs(spark, [(1, "x")] * 9), 3).collect()
    assert sorted(r["slot"] for r in same) == list(range(9)) and len({r["shard"] for r in same}) == 1


# -- lines -------------------------------------------------------------------
def slow_chunks(text):
    import hashlib

    ls = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in ls]
    r = [((h[i - 1] if i else 0) * lines.PREVIOUS + h[i] * lines.OWN) % lines.MODULUS for i in range(len(ls))]
    starts = [0] + [i for i in range(2, len(ls) - 1) if r[i] < r[i - 1] and r[i] <= r[i + 1]]
    return ["\n".join(ls[a:b]) for a, b in zip(starts, [*starts[1:], len(ls)])]


def slow_dedup(rows):
    first, out = {}, []
    for k, t in sorted({x for x in rows if x[1] is not None}, key=lambda x: (x[0] is not None, x[0] or 0)):
        for p, c in enumerate(slow_chunks(t)):
            if "\n" in c and c.split():
                first.setdefault(c, (k, t, p))
    for k, t in rows:
        kept = None if t is None else "\n".join(
            c for p, c in enumerate(slow_chunks(t)) if first.get(c, (k, t, p)) == (k, t, p)
        )
        out.append((k, kept))
    return out


def test_line_chunks_equal_brute_force(spark):
    rnd = random.Random(3)
    shared = ["\n".join(words(rnd, 5) for _ in range(14)) for _ in range(3)]
    rows = []
    for k in range(120):
        parts = [words(rnd, 6) for _ in range(rnd.randint(1, 12))]
        if k % 3 == 0:
            parts.insert(rnd.randint(0, len(parts)), rnd.choice(shared))
        rows.append((k, "\n".join(parts)))
    rows += [(500 + k, t) for k, t in enumerate(odd_texts())] + [(None, shared[0]), (7, rows[7][1]), (900, rows[3][1])]
    rows.append((901, "\n".join(words(rnd, 2) for _ in range(4000))))
    df = docs(spark, rows, extra=True)
    got = lines.dedup_lines(df)
    assert got.columns == df.columns and "Python" not in plan(got) and "Arrow" not in plan(got)
    want = slow_dedup(rows)
    order = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=order) == sorted(want, key=order)
    assert any(a != b for a, b in zip(rows, want))
    assert dict(want)[900] == ""  # a copy loses all its chunks, the original none
    assert dict(want)[3] == rows[3][1]


def test_line_counts(spark):
    rows = [(1, "a\nb\nc"), (2, "a\nb\nc"), (3, ""), (4, None), (5, "\n"), (6, "x")]
    got = lines.dedup_lines(docs(spark, rows), lines="n", removed="gone").collect()
    assert {r["doc_id"]: (r["text"], r["n"], r["gone"]) for r in got} == {
        1: ("a\nb\nc", 3, 0), 2: ("", 3, 3), 3: ("", 0, 0), 4: (None, 0, 0), 5: ("\n", 2, 0), 6: ("x", 1, 0)
    }
    assert lines.dedup_lines(docs(spark, [])).count() == 0
