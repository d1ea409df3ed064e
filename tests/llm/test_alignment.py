"""Operator 11 against a brute force over whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from corpus import docs, odd_texts, words
from tokenizers import Tokenizer

from pulsegrid.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(A, B)


def slow(pair, rows):
    """Whole texts through the libraries; every pair of tokens is compared."""
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    seen, links, out = Counter(), {}, {}
    for k, text in rows:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ranges = []
        for ids, table in ((a, pair.a_bytes), (b, pair.b_bytes)):
            at, r = 0, []
            for i in ids:
                r.append((at, at + len(table[i])))
                at += len(table[i])
            ranges.append(r)
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(t[i] for i in ids) != whole for ids, t in ((a, pair.a_bytes), (b, pair.b_bytes))):
            a, b, ranges = [], [], [[], []]
        found = [(x, y) for x, (p, q) in zip(a, ranges[0]) for y, (r, s) in zip(b, ranges[1]) if p < s and r < q]
        ends = sorted({q for _, q in ranges[0]} & {q for _, q in ranges[1]})
        groups = [
            ",".join(str(x) for x, (_, q) in zip(a, ranges[0]) if low < q <= high) + "|"
            + ",".join(str(y) for y, (_, q) in zip(b, ranges[1]) if low < q <= high)
            for low, high in zip([0, *ends], ends)
        ]
        links[k] = found
        seen.update(found)
        out[k] = [len(a), len(b), len(groups), len(found), ";".join(groups)]
    best = {}
    for (_, y), n in seen.items():
        best[y] = max(best.get(y, 0), n)
    for k, found in links.items():
        out[k][4:4] = [sum(seen[x] == best[x[1]] for x in found), sum(seen[x] for x in found)]
    return {k: tuple(v) for k, v in out.items()}, seen, best


def rows():
    rnd = random.Random(3)
    more = ["a b\nc d", "\nlead", "tail\n", "x \n y", "word　wide", "é ́", "naïve façade Ωmega 😀👩‍👩‍👧 日本語", "<s> </s> <unk> <0x41>",
            "tab\tbed", "a\n\nb", " \n", "▁under ▁ ▁", "\x00nul", "ﬁ ½ ²", "\xa0nb\xa0", "don't can't we'll", "\r\nx"]
    more += [words(rnd, rnd.randint(1, 80)) for _ in range(20)]
    more += ["".join(rnd.choice("ab \n\té日😀▁́") for _ in range(rnd.randint(1, 40))) for _ in range(150)]
    texts = odd_texts() + more
    return [*enumerate(texts), (1000, texts[19]), (1000, texts[19]), (None, "null key")]


def got(df):
    return {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in df.collect()}


def test_equals_brute_force(spark, pair):
    data = rows()
    want, seen, best = slow(pair, data)
    df = docs(spark, data, extra=True)
    assert got(alignment.align(df, A, B)) == want
    small = got(alignment.align(df.repartition(3), A, B, digest=True, block_chars=400))
    assert small == {
        k: (*v[:6], hashlib.sha256(v[6].encode()).hexdigest() if v[6] else "") for k, v in want.items()
    }
    counts = {(r["a_id"], r["b_id"]): (r["n"], r["top"]) for r in alignment.pair_counts(df, A, B).collect()}
    assert counts == {p: (n, n == best[p[1]]) for p, n in seen.items()}


def test_empty_tables(spark):
    assert alignment.align(docs(spark, []), A, B).count() == 0
    none = alignment.align(docs(spark, [(1, None), (2, "")]), A, B, digest=True).collect()
    assert [tuple(r)[1:] for r in none] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_long_texts_in_pieces(pair):
    rnd = random.Random(4)
    for text in (words(rnd, 3000), "  " + words(rnd, 500) + " \n", "x" * 5000):
        whole = [u for part in alignment.pieces_of(text, 10**9) for u in part]
        assert [u for part in alignment.pieces_of(text, 100) for u in part] == whole


def test_ends_are_refined_by_decoded_bytes():
    # a shared character (offsets repeat) and byte fallback (empty spans before the last one)
    assert alignment.byte_ends([1, 4, 4, 4, 5], [1, 1, 1, 1, 1]) == [1, 2, 3, 4, 5]
    assert alignment.byte_ends([1, 1, 1, 4], [1, 1, 1, 1]) == [1, 2, 3, 4]


def test_cache_is_bounded(pair, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_UNITS", 3)
    cache = alignment.Cache(pair)
    first = cache.find(["one", "two.", "three"])
    for k in range(6):
        cache.find(["one", f"w{k}", f"v{k}"])
        assert len(cache.new) + len(cache.old) <= 12 and cache.new["one"] == first[0]
    assert cache.find(["two."]) == [first[1]]


def test_cache_is_bounded_in_bytes(pair, monkeypatch):
    """Units without blanks can be whole texts, so their number alone bounds nothing."""
    monkeypatch.setattr(alignment, "CACHE_BYTES", 3000, raising=False)
    cache = alignment.Cache(pair)
    for k in range(8):
        cache.find([f"{k}" * 2000])
        assert len(cache.new) == 1 and len(cache.old) == (k > 0)


def test_libraries_get_few_units_at_once(pair, monkeypatch):
    monkeypatch.setattr(alignment, "ALIGN_UNITS", 5, raising=False)
    monkeypatch.setattr(alignment, "ALIGN_CHARS", 40, raising=False)
    keys = [f"w{k}," for k in range(30)] + ["x" * 50, "\nline", "  two", "été"] + ["y" * 30 + str(k) for k in range(4)]
    asked, align = [], pair.align
    monkeypatch.setattr(pair, "align", lambda spaced, bare: asked.append([*spaced, *bare]) or align(spaced, bare))
    found = alignment.Cache(pair).find(keys)
    assert max(map(len, asked)) <= 5 and all(sum(map(len, x[:-1])) < 40 + 50 for x in asked)
    monkeypatch.undo()
    assert found == alignment.Cache(pair).find(keys)


def test_words_and_signs_apart(pair):
    """A word with signs behind it is the same as a whole."""
    whole, split = alignment.Cache(pair), alignment.Cache(pair)
    whole.pair = pair
    keys = ["word.", "été),", "a++", "x²...", "O'Neil's\"", "\nNext,", "  two;", "日本.", "I_", "don't?!"]
    signs, pair.signs = pair.signs, ""
    try:
        plain = whole.find(keys)
    finally:
        pair.signs = signs
    assert "," in signs and plain == split.find(keys)
