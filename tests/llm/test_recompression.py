"""Operator 12 against brute force over all windows."""

import hashlib
import random
import re

import numpy as np
from corpus import docs, odd_texts, words

from pulsegrid.llm import recompression


def slow(rows, n):
    cut = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    rank = lambda k: (k is None, k or 0)
    first = {}
    for (k, _), w in zip(rows, cut):
        for i in range(len(w) - n + 1):
            x = tuple(w[i:i + n])
            first[x] = min(first.get(x, rank(k)), rank(k))
    out = []
    for (k, _), w in zip(rows, cut):
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < rank(k):
                gone |= set(range(i, i + n))
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, n):
    found = recompression.repeated_windows(df, n=n).collect()
    for r in found:
        assert (r["kept"] is None) == (r["n_removed"] == 0)
        assert r["kept"] is None or hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found), key=str)


def corpus():
    rnd = random.Random(21)
    long = words(rnd, 700)
    parts = long.split()
    rows = [long, long, long.replace(" ", "\n ", 3)]
    for _ in range(12):  # near copies
        w = list(parts)
        for _ in range(rnd.randint(1, 12)):
            w[rnd.randrange(len(w))] = words(rnd, 1) + "x"
        rows.append(" ".join(w))
    for m in (48, 49, 50, 51, 70, 120):
        p = words(rnd, m)
        rows += [f"{words(rnd, rnd.randint(0, 90))} {p}\t{words(rnd, rnd.randint(0, 90))}" for _ in range(3)]
        rows.append(p)
    rows += ["lone " * 49, "lone " * 50, "lone " * 300, "a b " * 40, "a b " * 90, "b a " * 90, words(rnd, 200) + " " + "a b " * 60]
    own = words(rnd, 60)
    rows += [f"{own} cut {own}", f"{own} {own} {own}", "x " * 20 + own]
    rows += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(40, 200))) for _ in range(30)]
    rows += odd_texts()
    keyed = [(rnd.randint(0, 60), t) for t in rows]  # ties of keys with differing texts
    keyed += [(None, long), (None, own + " null key"), (None, own + " null key"), keyed[3], keyed[3], (-5, None)]
    return keyed


def test_equals_brute_force(spark):
    rows = corpus()
    df = docs(spark, rows, extra=True)
    assert got(df, 50) == slow(rows, 50)
    assert got(df.repartition(7), 8) == slow(rows, 8)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert got(df, 50) == slow([tuple(r) for r in df.collect()], 50)


def test_one_window_and_empty_tables(spark):
    assert recompression.repeated_windows(docs(spark, [])).count() == 0
    assert got(docs(spark, [(1, "a"), (2, "a b"), (3, "b a")]), 1) == slow([(1, "a"), (2, "a b"), (3, "b a")], 1)


def test_shared_names_are_found_out(spark, monkeypatch):
    rnd = random.Random(22)
    texts = [words(rnd, 80) for _ in range(4)]
    rows = [*enumerate(texts), (9, texts[0] + " tail")]
    df = docs(spark, rows)
    true, seen = recompression.hashes_of, []

    def weak(w, seed):  # under the first seed all words are alike
        seen.append(seed)
        return np.full(len(w), 7, np.uint64) if seed == 0 else true(w, seed)

    attempts = []
    one = recompression._attempt

    def traced(*given):
        found = one(*given)
        attempts.append(found is not None)
        return found

    monkeypatch.setattr(recompression, "_attempt", traced)
    monkeypatch.setattr(recompression, "hashes_of", weak)
    assert got(df, 50) == slow(rows, 50)
    assert attempts == [False, True]


def test_interior_symbols_agree():
    """Every symbol whose determining words lie in a shared stretch has the same name in both texts."""
    rnd = random.Random(23)
    for alphabet in (2, 40, 4000):
        shared = [rnd.randrange(1, alphabet + 1) for _ in range(120)]
        parts, at = [], []
        for _ in range(2):
            head = [rnd.randrange(1, alphabet + 1) for _ in range(rnd.randint(0, 40))]
            tail = [rnd.randrange(1, alphabet + 1) for _ in range(rnd.randint(0, 40))]
            name = np.array(head + shared + tail, np.uint64)
            zero = np.zeros(len(name), np.int32)
            parts.append((name, zero + np.int32(1), zero + np.int32(2), zero, zero))
            at.append(len(head))
        seen = []
        for (name, count, _, before, behind), start in zip(
            recompression._parts(recompression._joined(parts)[0].compress(8, 0)), at
        ):
            stop = np.cumsum(count)
            inside = (stop - count - before >= start) & (stop + behind <= start + 120)
            seen.append({(int(s) - start, int(x)) for s, x in zip((stop - count)[inside], name[inside])})
        assert seen[0] == seen[1] and (alphabet < 3 or len(seen[0]) > 4)


def test_words_in_pieces(monkeypatch):
    raw = b"  one two\n\nthree \x0bfour  "
    monkeypatch.setattr(recompression, "PIECE", 2)
    assert [w for part in recompression.words_in(raw) for w in part] == raw.split()
    assert recompression._normal(raw) == b" ".join(raw.split())
    h = recompression.hashes_of([b"%d" % i for i in range(300)], 0)
    for n in (1, 2, 3, 7, 50, 300):
        assert len(recompression.window_hashes(h, n)) == 301 - n
        again = recompression.window_hashes(np.concatenate([h[9:], h]), n)
        assert (again[291:] == recompression.window_hashes(h, n)).all()
