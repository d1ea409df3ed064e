"""The near-copy stage against all pairs."""

import random

import corpus_pipeline
import numpy as np
import pytest
from corpus import docs, odd_texts, words

from pulsegrid.llm import nearcopies, simhash


def slow_groups(texts):
    """The smallest index of each text's group."""
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets.append({b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            n = len(sets[i] | sets[j])
            if (5 * len(sets[i] & sets[j]) >= 4 * n) if n else True:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def edited(rnd, text, edits):
    parts = text.split(" ")
    for at in rnd.sample(range(len(parts)), edits):
        parts[at] = f"new{rnd.randint(0, 10**9)}"
    return " ".join(parts)


def near_rows():
    rnd = random.Random(21)
    rows = []
    for n in (6, 12, 40, 64, 150, 400):
        for _ in range(6):
            text = words(rnd, n)
            rows.append(text)
            # from 0.97 to well below 0.8
            rows += [edited(rnd, text, k) for k in (1, max(1, n // 60), max(1, n // 45), max(1, n // 30), max(1, n // 15))]
    chain = words(rnd, 200)
    for _ in range(12):  # neighbours are similar, the ends are not
        rows.append(chain)
        chain = edited(rnd, chain, 3)
    rnd.shuffle(rows)
    return list(enumerate(rows + odd_texts()))


@pytest.mark.parametrize("chunk", [nearcopies.CHUNK, 2])
def test_near_copies_equal_all_pairs(spark, chunk):
    rows = near_rows()
    want = slow_groups([t for _, t in rows])
    got = nearcopies.keep_first(docs(spark, rows, extra=True), chunk=chunk)
    assert got.columns == docs(spark, rows, extra=True).columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(want))
    assert nearcopies.keep_first(docs(spark, [])).count() == 0


def test_stage_takes_five_words_and_four_fifths(spark):
    rnd = random.Random(22)
    base = words(rnd, 64)
    rows = [(1, base)] + [(2 + k, edited(rnd, base, 1)) for k in range(8)] + [(20, words(rnd, 64))]
    kept = corpus_pipeline.near_copies(spark, docs(spark, rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 20]


def test_forest_joins_pieces():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 60, 100))
    sets = [base, base[:90], base[:75], np.unique(rng.integers(0, 1 << 60, 80))]
    nodes = np.arange(4)
    links = nearcopies.forest(nodes, nodes, sets)
    assert links == [(0, 1), (1, 2)]
    assert nearcopies.forest(nodes, np.array([0, 0, 2, 3]), sets) == [(1, 2)]


def test_one_row_of_each_group(spark):
    rnd = random.Random(23)
    a, b, c, d, e = (words(rnd, 80) for _ in range(5))
    rows = [(1, a)] * 3 + [(None, b)] * 2 + [(None, c), (7, c), (8, c)] + [(None, d), (None, edited(rnd, d, 1))]
    rows += [(9, e), (9, edited(rnd, e, 1)), (30, None), (30, ""), (None, " ")]
    kept = nearcopies.keep_first(docs(spark, rows, extra=True)).collect()
    got = sorted(((r["doc_id"] or 0), (r["text"] or "")[:20]) for r in kept)
    assert [k for k, _ in got] == [0, 0, 1, 7, 9, 30]
    assert {(1, a[:20]), (7, c[:20]), (0, b[:20])} <= set(got)


def test_pivot_tables_find_near_copies_without_bands(spark, monkeypatch):
    rnd = random.Random(24)
    rows = []
    for g in range(30):
        text = words(rnd, 400)
        rows += [(10 * g, text), (10 * g + 1, edited(rnd, text, 1)), (10 * g + 2, edited(rnd, text, 1))]
    # what MinHash alone would find is taken away: the search by pivot tables is a step of the stage
    monkeypatch.setattr(nearcopies, "_candidates", lambda nodes: nodes.selectExpr("node AS a", "node AS b").limit(0))
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs(spark, rows), "").collect()}
    assert {10 * g for g in range(30)} <= kept and len(kept) <= 33


def test_wide_links_reach_every_pair_that_agrees_in_two_blocks(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(i) for i in rng.choice(26, 9, replace=False))) for b in base]
    found = simhash.links(spark.createDataFrame([(int(x),) for x in {*base.tolist(), *map(int, near)}], "fp long"), bits=9).collect()
    got = {frozenset((r["a"], r["b"])) for r in found}
    assert {frozenset((int(a), int(b))) for a, b in zip(base, near)} <= got
    assert all(bin((r["a"] ^ r["b"]) % (1 << 64)).count("1") <= 9 for r in found)
