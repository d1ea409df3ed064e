"""Operators 2, 3 and 9 and the components."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from corpus import docs, odd_texts, words

from pulsegrid.llm import simhash, suffixes, vptree
from pulsegrid.llm.components import components


# -- components --------------------------------------------------------------
def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    links = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 200)]
    links += [(rnd.randint(2000, 2100), rnd.randint(2000, 2100)) for _ in range(60)] + [(5, 5), (7, 6)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- fingerprints ------------------------------------------------------------
def slow_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for t in odd_texts():
        assert simhash.fingerprint(t) % (1 << 64) == slow_fingerprint(t)


def test_pivot_coordinates_are_block_distances():
    fp = np.random.default_rng(1).integers(0, 1 << 63, 50).astype(np.uint64)
    got = simhash.block_coordinates(simhash.pivot_table(fp))
    for b, mask in enumerate(simhash.MASKS):
        want = np.bitwise_count((fp[:, None] ^ simhash.BASES[None, :]) & mask)
        assert (got[:, b] == want).all()


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 4])
def test_groups_equal_brute_force(spark, monkeypatch, chunk):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(40)] + [0]
    fps = list(base)
    for f in base:
        for _ in range(rnd.randint(0, 6)):  # chains of close fingerprints
            for bit in rnd.sample(range(64), rnd.randint(0, 4)):
                f ^= 1 << bit
            fps.append(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.links(spark.createDataFrame([(x,) for x in sorted(set(signed))], "fp long"), chunk)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    known = sorted(set(signed))
    root = list(range(len(known)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(known)):
        for j in range(i):
            if bin((known[i] ^ known[j]) % (1 << 64)).count("1") <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert [got.get(f, f) for f in known] == [known[find(i)] for i in range(len(known))]


def test_near_duplicates_of_odd_rows(spark):
    rnd = random.Random(3)
    text = words(rnd, 400)
    rows = [(k + 10, t) for k, t in enumerate(odd_texts())] + [(3, text), (4, text + " more"), (3, text), (None, "solo words here")]
    got = simhash.near_duplicates(docs(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add(r["component_id"])
    assert by[4] == {3} and by[3] == {3} and by[None] == {None}
    blank = [k for k, t in rows if not (t or "").encode().split()]
    assert all(by[k] == {min(blank)} for k in blank)
    kept = simhash.keep_first(docs(spark, rows, extra=True))
    assert kept.columns == docs(spark, rows, extra=True).columns
    assert sorted(k for k in (r["doc_id"] for r in kept.collect()) if k in (3, 4)) == [3, 3]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


# -- neighbours --------------------------------------------------------------
SCHEMA = "vec_id long, embedding array<float>, points string, ids int"


def nearest(spark, rows, k=20, **options):
    valid = vptree.valid_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    return vptree.nearest(valid, valid.filter("id % 20 = 0"), k, **options).collect()


def slow_nearest(rows, k):
    known = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows}
    out = {}
    for q in known:
        if q % 20 == 0:
            s = sorted((-float(sum(a * b for a, b in zip(known[q], v))), i) for i, v in known.items() if i != q)
            out[q] = [i for _, i in s[:k]]
    return out


@pytest.mark.parametrize("shard_rows,relax", [(16_384, 1.0), (150, 1.0), (150, 2.0)])
def test_neighbours_and_recall(spark, shard_rows, relax):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=6).astype(np.float32).tolist(), "x", 1) for k in range(700)]
    same = rng.normal(size=6).astype(np.float32).tolist()
    rows += [(1000 + k, same, "x", 1) for k in range(300)]  # a hot vector with many ties
    got = defaultdict(dict)
    for r in nearest(spark, rows, shard_rows=shard_rows, relax=relax):
        got[r["query_id"]][r["rank"]] = r["vec_id"]
    want = slow_nearest(rows, 20)
    assert got.keys() == want.keys()
    found = {q: [got[q][n] for n in range(1, 21)] for q in want}
    recall = np.mean([len(set(found[q]) & set(want[q])) / 20 for q in want])
    assert recall >= 0.9
    if relax == 1.0:
        assert found == want


def test_trees_are_sent_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(k, v.astype(np.float32).tolist(), "x", 1) for k, v in enumerate(rng.normal(size=(12_000, 4)))]
    sent, send = [], vptree.map_arrow

    def seen(df, make, schema):
        sent.extend(r[0] for r in df.selectExpr("length(points)").collect())
        return send(df, make, schema)

    monkeypatch.setattr(vptree, "map_arrow", seen)
    # a third of the rows ask: their batches are many, and each meets every tree
    valid = vptree.valid_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    got = vptree.nearest(valid, valid.filter("id % 3 = 0"), 5, 1.0, shard_rows=6_000).collect()
    v = np.array([r[1] for r in rows])
    for q in (0, 6_000, 11_997):
        s = -(v @ v[q])
        s[q] = np.inf
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == s.argsort()[:5].tolist()
    assert sum(x or 0 for x in sent) == 12_000 * 5 * 8 and max(x or 0 for x in sent) <= 1 << 20


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0], "x", 1), (1, [2.0, 1.0], None, None), (20, None, "x", 1), (2, [], "x", 1), (3, [0.0, 0.0], "x", 1),
            (4, [1.0, None], "x", 1), (5, [float("nan"), 1.0], "x", 1), (6, [float("inf"), 1.0], "x", 1),
            (7, [1.0, 2.0, 3.0], "x", 1), (None, [1.0, 1.0], "x", 1), (1, [2.0, 1.0], "x", 1), (40, [-1.0, 0.0], "x", 1)]
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in nearest(spark, rows)}
    assert got == {(0, 1): (1, 4.0), (0, 2): (40, -1.0), (40, 1): (0, -1.0), (40, 2): (1, -2.0)}
    assert nearest(spark, []) == []


# -- substrings --------------------------------------------------------------
def slow_removal(rows):
    raws = [(t or "").encode() for _, t in rows]
    n = suffixes.LENGTH
    seen = Counter(r[i:i + n] for r in raws for i in range(len(r) - n + 1))
    out = []
    for (k, _), r in zip(rows, raws):
        mark = bytearray(len(r))
        for i in range(len(r) - n + 1):
            if seen[r[i:i + n]] > 1:
                mark[i:i + n] = b"\1" * n
        kept = bytes(c for c, m in zip(r, mark) if not m)
        runs = sum(1 for i in range(len(r)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((k, len(r), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0, x[4]))


def copied_rows():
    rnd = random.Random(5)
    text = lambda n: "".join(rnd.choice("abcdefghé \n") for _ in range(n))
    passages = [text(n) for n in (380, 398, 399, 400, 401, 430, 520, 900)]
    rows = []
    for k in range(70):
        parts = [text(rnd.randint(0, 500)) for _ in range(rnd.randint(1, 3))]
        for _ in range(rnd.randint(0, 2)):
            parts.insert(rnd.randint(0, len(parts)), rnd.choice(passages))
        rows.append((k, "".join(parts)))
    inner = text(450)
    rows += [(200, inner + text(50) + inner), (201, text(2000)), (202, rows[5][1]), (None, rows[5][1]), (5, rows[5][1])]
    edited = list(rows[8][1] + text(1500))
    rows.append((203, "".join(edited)))
    edited[700] = "#"
    rows.append((204, "".join(edited)))
    return rows + [(300 + k, t) for k, t in enumerate(odd_texts())] + [(400, "ab" * 700), (401, "x" * 405)]


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_removal_equals_brute_force(spark, hot):
    rows = copied_rows()
    got = suffixes.removal_report(docs(spark, rows, extra=True), hot=hot).collect()
    seen = sorted((tuple(r) for r in got), key=lambda x: (x[0] is not None, x[0] or 0, x[4]))
    assert seen == slow_removal(rows)
    assert suffixes.removal_report(docs(spark, [])).count() == 0


def test_crowded_blocks_write_few_rows(spark, monkeypatch):
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefgh \n") for _ in range(n))
    passage, longer = text(300), text(420)
    rows = [(k, text(rnd.randint(250, 400)) + passage + text(rnd.randint(250, 400))) for k in range(40)]
    rows += [(100 + k, text(300) + longer + text(300)) for k in range(4)]
    counts, write = Counter(), suffixes.written

    def counted(df, purpose, **options):
        out = write(df, purpose, **options)
        counts[purpose] = max(counts[purpose], out.count())
        return out

    monkeypatch.setattr(suffixes, "written", counted)
    got = suffixes.removal_report(docs(spark, rows), hot=8).collect()
    assert sorted(tuple(r) for r in got) == slow_removal(rows)
    # not one row for each string around an anchor
    assert max(counts.values()) <= 8 * sum(len(suffixes.anchors(t.encode())) for _, t in rows)


def test_crowded_blocks_in_the_substrings_stage(spark, monkeypatch):
    rnd = random.Random(10)
    text = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    passage, longer = text(300), text(420)
    rows = [(k, text(rnd.randint(250, 400)) + passage + text(rnd.randint(250, 400))) for k in range(30)]
    rows += [(100 + k, text(300) + longer + text(300)) for k in range(3)]
    most, write = [], suffixes.written

    def counted(df, purpose, **options):
        out = write(df, purpose, **options)
        most.append(out.count())
        return out

    monkeypatch.setattr(suffixes, "written", counted)
    got = suffixes.dedup_substrings(docs(spark, rows), hot=8, passage_words=51).collect()
    # each text is one word, so only bytes repeat
    assert {(r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in got} == {(x[0], x[4]) for x in slow_removal(rows)}
    assert max(most) <= 8 * sum(len(suffixes.anchors(t.encode())) for _, t in rows)


def test_texts_without_the_repeats(spark):
    rows = copied_rows()
    df = docs(spark, rows, extra=True)
    got = suffixes.dedup_substrings(df)
    assert got.columns == df.columns
    want = {(x[0], x[4]) for x in slow_removal(rows)}
    plain = [r for r in got.collect() if r["text"] is not None]
    hits = sum((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) in want for r in plain)
    assert len(plain) == sum(t is not None for _, t in rows) and hits >= 0.8 * len(plain)  # others had a character cut


def test_anchors_by_brute_force(monkeypatch):
    rnd = random.Random(6)
    for text in ("".join(rnd.choice("abc") for _ in range(1500)), "ab" * 400, "a" * 700, "x" * 399):
        raw = text.encode()
        h = suffixes.gram_hashes(np.frombuffer(raw, np.uint8)) if len(raw) > 16 else []
        keep = ~np.uint64((1 << 22) - 1)
        want = set()
        for p in range(len(raw) - suffixes.LENGTH + 1):
            own = (h[p:p + suffixes.REACH] & keep).tolist()
            want.add(p + own.index(min(own)))
        assert suffixes.anchors(raw).tolist() == sorted(want) == suffixes.anchors(raw, 100).tolist()


def test_merge_is_sorted_with_right_prefixes():
    rnd = random.Random(7)
    runs = []
    for _ in range(9):
        run = [("".join(rnd.choice("ab") for _ in range(rnd.randint(0, 40))).encode(), b"l" * rnd.randint(0, 2), 1) for _ in range(30)]
        runs.append(run)
    merged = list(suffixes.merge_runs([suffixes.decode_run(suffixes.encode_run(r)) for r in runs]))
    assert [x[1] for x in merged] == sorted(x[1] for x in merged)
    assert sum(x[3] for x in merged) == 270
    last = b""
    for p, right, _, _ in merged:
        assert p == len(__import__("os").path.commonprefix([last, right]))
        last = right
