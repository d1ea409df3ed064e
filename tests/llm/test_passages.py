"""Repeated passages by words against brute force."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
from corpus import docs, odd_texts, words

from pulsegrid.llm import passages, suffixes

N = 51


def short(rnd, n):
    """Words of one to four bytes: 60 of them are less than 400 bytes."""
    return " ".join("".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(1, 4))) for _ in range(n))


def passage_rows():
    rnd = random.Random(31)
    planted = {n: short(rnd, n) for n in (49, 50, 51, 52, 55, 60)}
    rows = []
    for p in planted.values():
        assert len(p.encode()) < 400
        rows += [f"{short(rnd, rnd.randint(0, 80))} {p} {short(rnd, rnd.randint(0, 80))}" for _ in range(3)]
    rows.append(f"{short(rnd, 9)}\n{planted[60].replace(' ', '\n ')}\t{short(rnd, 9)}")  # spaced in another way
    rows += [short(rnd, 300), words(rnd, 300), "a " * 60, "lone " * 50]
    return list(enumerate(rows + odd_texts())), planted


def slow_spans(rows):
    cut = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + N]) for w in cut for i in range(len(w) - N + 1))
    out = {}
    for (k, _), w in zip(rows, cut):
        gone = set()
        for i in range(len(w) - N + 1):
            if seen[tuple(w[i:i + N])] > 1:
                gone |= set(range(i, i + N))
        out[k] = [x for i, x in enumerate(w) if i not in gone]
    return out


def test_passages_equal_brute_force(spark):
    rows, _ = passage_rows()
    want, texts = slow_spans(rows), dict(rows)
    found = passages.repeated_passages(docs(spark, rows, extra=True), N).collect()
    import hashlib

    spans = {bytes(r["digest"]): r["spans"] for r in found}
    for k, t in rows:
        raw, left, at = (t or "").encode(), b"", 0
        for x in spans.get(hashlib.sha256(raw).digest(), []):
            left, at = left + raw[at:x["start"]] + b" ", x["stop"]
        assert (left + raw[at:]).split() == want[k], texts[k]
    assert passages.repeated_passages(docs(spark, []), N).count() == 0


def test_stage_cuts_passages_of_51_words(spark):
    rows, planted = passage_rows()
    df = docs(spark, rows)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_substrings(spark, df, "").collect()}
    for n, p in planted.items():
        assert sum(p in t for t in got.values()) == (3 if n < N else 0)
    texts = dict(rows)
    assert all(got[k] == texts[k] for k in (19, 20, 22))


def test_copies_are_cut_as_a_whole(spark):
    rnd = random.Random(32)
    text = short(rnd, 60)
    rows = [(1, text), (2, text), (3, "x y"), (4, "x y")]
    got = corpus_pipeline.repeated_substrings(spark, docs(spark, rows), "").collect()
    assert sorted(r["doc_id"] for r in got) == [3, 4]


def test_anchors_by_brute_force(monkeypatch):
    rnd = random.Random(33)
    for text in (short(rnd, 400), "a b " * 100, "x " * 70, "x " * 50):
        w = text.encode().split()
        got, h = passages.anchors(w, N)
        want = []
        for p in range(len(w) - N + 1):
            own = (h[p:p + N - passages.GRAM + 1] & ~np.uint64((1 << 22) - 1)).tolist()
            want.append(p + own.index(min(own)))
        assert got.tolist() == want
        with monkeypatch.context() as m:
            m.setattr(passages, "PIECE", 37)
            assert passages.anchors(w, N)[0].tolist() == want


def test_characters_go_whole_and_replacement_characters_stay(spark):
    rnd = random.Random(34)
    text = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    p, q = text(500), text(450)
    # é and è share their first byte, é and ũ their last one
    rows = [(1, f"one\ufffd {p}é two\ufffd"), (2, f"{p}è three"), (3, f"four é{q} \ufffd"), (4, f"five ũ{q}. six"), (5, "x\ufffdy")]
    got = {r["doc_id"]: r["text"] for r in suffixes.dedup_substrings(docs(spark, rows)).collect()}
    assert got == {1: "one\ufffd  two\ufffd", 2: " three", 3: "four  \ufffd", 4: "five . six", 5: "x\ufffdy"}
