"""Operator 13 against dense rows in Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from corpus import CLASH
from pyspark.sql import functions as F

from pulsegrid.llm import divergence

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def slow(rows, min_docs, top):
    groups, docs, langs = defaultdict(Counter), Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        found = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang or "", source or ""].update(found)
        langs[lang or ""].update(found)
        docs.update((lang or "", t) for t in set(found))
    out = []
    for (lang, source), own in groups.items():
        kept = [t for t in langs[lang] if docs[lang, t] >= min_docs]
        v = len(kept)

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        mine, whole = p(own), p(langs[lang])
        pairs = []
        for (la, so), other in groups.items():
            if la == lang and so != source:
                q = p(other)
                pairs.append((so, sum(f(mine[t], q[t]) for t in kept)))
        terms = [(t, f(mine[t], whole[t])) for t in kept if own[t] and mine[t] > whole[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    return df.select(*[F.lit(1).alias(c) for c in CLASH], F.lit("x").alias("term"), F.lit(2).alias("n"), "*")


def corpus():
    rnd = random.Random(6)
    vocab = ["the", "The", "été", "ÉTÉ", "naïve", "日本", "a", "x-y", "O'N", "12ab34", "z", "q\x7fr", "[k]", "{m}"] + [f"w{c}" for c in "abcdefghij"]
    rows = []
    for k in range(300):
        lang = rnd.choice(["en", "fr", None])
        source = "hot" if rnd.random() < 0.4 else rnd.choice(["s1", "s2", "", None, "Ω"])
        own = vocab[: rnd.randint(3, len(vocab))] if source != "s1" else vocab[::2]
        rows.append((" ".join(rnd.choice(own) for _ in range(rnd.randint(0, 30))), lang, source))
    rows += [("the the", "xx", "one"), (None, "xx", "two"), ("", "xx", "three"), ("1 2 3", "en", "no terms"), ("a", "lone", "only")]
    return rows + rows[:7]


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    df = table(spark, rows)
    assert sorted(map(tuple, divergence.audit(df).collect())) == slow(rows, 10, 10)
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", 7)
    monkeypatch.setattr(divergence, "SLICE", 2)
    assert sorted(map(tuple, divergence.audit(df.repartition(5), min_docs=3, top=2).collect())) == slow(rows, 3, 2)


def test_empty_table(spark):
    assert divergence.audit(table(spark, [])).count() == 0


def test_pieces_cut_no_term(monkeypatch):
    raw = "ab été-cd  Ef日本 g1h".encode()
    whole = [t for part in divergence.terms_in(raw) for t in part]
    monkeypatch.setattr(divergence, "PIECE", 1)
    assert [t for part in divergence.terms_in(raw) for t in part] == whole
    assert [t.decode() for t in whole] == ["ab", "été", "cd", "ef日本", "g", "h"]


def test_accumulate_equals_dense_rows():
    rnd = np.random.default_rng(2)
    p0 = rnd.integers(1, 50, 6)
    dense = np.where(rnd.random((9, 6)) < 0.4, rnd.integers(50, 900, (9, 6)), -1)
    term, peer = np.nonzero(dense >= 0)
    full = np.where(dense < 0, p0, dense)
    want = divergence._f(full[:, :, None], full[:, None, :]).sum(0) + 4 * divergence._f(p0[:, None], p0)
    # 4 terms more occur in no source; all 13 start as absent
    got = divergence.accumulate(np.arange(6), p0, term, peer, dense[term, peer], np.arange(6), 13)
    assert (got == want).all()
