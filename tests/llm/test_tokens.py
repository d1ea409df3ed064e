"""Operators 1, 6 and 8 against the tokenizers library."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus import docs, odd_texts, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsegrid.llm import bpe, orc_tokens, packing
from pulsegrid.llm.frames import shared_dir
from pulsegrid.llm.tokens import COMMON, Encoder

PATHS = [public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json")]


@pytest.fixture(scope="module", params=PATHS)
def pair(request):
    return request.param, Tokenizer.from_file(request.param)


def reference(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(pair):
    path, tok = pair
    enc, rnd = Encoder(path), random.Random(2)
    noise = ["".join(rnd.choice("abé'1!. \n\t 日ςΣ<|") for _ in range(rnd.randint(1, 40))) for _ in range(600)]
    for text in [*odd_texts(), *noise]:
        assert enc.encode(text).tolist() == reference(tok, text), text
        assert enc.decode(enc.encode(text)) == tok.decode(reference(tok, text), skip_special_tokens=False)


def test_ids_and_sentence_ends_in_one_call():
    tok, enc, rnd = Tokenizer.from_file(PATHS[1]), Encoder(PATHS[1]), random.Random(5)
    common = [chr(c) for c in range(0x2100) if not re.search(f"[^{COMMON}]", chr(c))]
    each = [f"a{c}b 1{c}2 {c} x{c} .{c}' {c}{c}1" for c in common if c not in " \n"]
    noise = ["".join(rnd.choice([*"aB's1!?. .\n ", rnd.choice(common)]) for _ in range(rnd.randint(1, 60))) for _ in range(800)]
    plain = [re.sub("[ \n]+", lambda m: rnd.choice(" \n"), x) for x in noise]
    lines = ["\n", " ", " .", ". ", "a.\nb! c", "\n'll go?", "It's 3.5 km. Isn't it? \u201cYes\u201d \u2014 no"]
    for text in [*lines, *each, *plain]:
        ids, ends = enc.encode_with_ends(text)
        assert ids.dtype == np.dtype("<i4") and ids.tolist() == reference(tok, text), text
        stops = {m.start() for m in re.finditer(r"(?<=[.!?]) |\n", text)} - {0} | {len(text)}
        assert ends.tolist() == [len(reference(tok, text[:p])) for p in sorted(stops)], text
    assert not enc._units  # no unit was looked up alone
    for text in [*odd_texts(), *noise, "two  blanks. so", "tab\tand. so", "<|endoftext|> x", "\x00 a. b", "日本. 語"]:
        assert enc.encode_with_ends(text)[0].tolist() == reference(tok, text), text


def test_entries_encode_to_themselves(pair):
    """Then the merge loop over ranks and the library's merges agree."""
    path, tok = pair
    enc = Encoder(path)
    back = {c: b for b, c in enumerate(enc._alphabet)}
    for i, token in enumerate(enc.tokens):
        if token not in enc.specials:
            body = token.removesuffix(enc.suffix) if enc.suffix else token
            if body and valid(bytes(back[c] for c in body)) and token.endswith(enc.suffix):
                assert [t.id for t in tok.model.tokenize(body)] == [i], token


def valid(raw):
    try:
        return bool(raw.decode())
    except UnicodeDecodeError:
        return False


def test_joined_leaves_equal_the_whole(pair):
    path, tok = pair
    enc = Encoder(path)
    joiner, rnd = bpe.Joiner(enc), random.Random(3)
    for alphabet in ("ab", "abcdefghijkl", "aaaaaaab", "the in ation er", "ab'st ", "éàœ日本", "0123456789", "!?*$ ab'"):
        for _ in range(15):
            text = enc.normalize("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 2000))))
            parts = [(p, enc.encode_normal(p)) for p in bpe.leaves(text, 80) if p]
            assert bpe.join_tree(joiner, parts).tolist() == enc.plain.encode(text, add_special_tokens=False).ids


def test_encode_and_decode_on_spark(spark, pair):
    path, tok = pair
    texts = odd_texts()
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (3, texts[3])]
    got = bpe.encode(docs(spark, rows, extra=True), path, decoded="back", long_chars=100, leaf_chars=64)
    assert got.columns[-2:] == ["ids_", "back"]
    seen = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids_"], r["back"]) for r in got.collect())
    want = sorted(
        (k is None, k or 0, reference(tok, t), tok.decode(reference(tok, t), skip_special_tokens=False)) for k, t in rows
    )
    assert seen == want
    assert bpe.encode(docs(spark, []), path).count() == 0


def test_orc_round_trip_and_pruning(spark):
    path = PATHS[0]
    tok = Tokenizer.from_file(path)
    rows = [(7 * k % 50 if k % 9 else None, t) for k, t in enumerate(odd_texts() * 2)]
    out = shared_dir(spark, "test-orc")
    orc_tokens.write_tokens(docs(spark, rows, extra=True), path, out)
    stored = orc_tokens.read_tokens(spark, out)
    got = sorted(orc_tokens.digests(stored).collect(), key=lambda r: r["start"])
    at, left = 0, defaultdict(list)
    for k, t in rows:
        left[k].append(np.array([*reference(tok, t), 2], "<u4"))
    assert [r["doc_id"] for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        same = [k for k, a in enumerate(left[r["doc_id"]]) if (len(a), zlib.crc32(a.tobytes())) == (r["n_tokens"], r["ids_crc32"])]
        left[r["doc_id"]].pop(same[0])
    one = orc_tokens.read_tokens(spark, out, F.col("doc_id") == 14)
    assert {r["doc_id"] for r in one.collect()} == {14}
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,14)]" in one._jdf.queryExecution().toString()
    empty = shared_dir(spark, "test-orc")
    orc_tokens.write_tokens(docs(spark, []), path, empty)
    assert orc_tokens.digests(orc_tokens.read_tokens(spark, empty)).count() == 0


def cheapest(places, costs, window):
    """All ways, by trying every predecessor."""
    best = [0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            size = places[j] - places[i]
            if size <= window and best[i] is not None:
                pad = 0 if size in packing.EXACT and size < window else window - size
                if best[j] is None or best[i] + pad < best[j]:
                    best[j] = best[i] + pad
        best[j] += costs[j]
    return best[-1]


def test_cuts_are_the_cheapest():
    rnd = random.Random(4)
    for _ in range(60):
        places = np.cumsum([0] + [rnd.choice([1, 5, 40, 128, 250, 256]) for _ in range(rnd.randint(1, 60))])
        costs = np.array([0] + [rnd.choice([0, 8, 64]) for _ in places[1:]])
        got = packing.best_cuts(places, costs, 2048)
        total, last = 0, 0
        for j in got:
            size = int(places[j] - places[last])
            total += (0 if size in packing.EXACT else 2048 - size) + int(costs[j])
            last = j
        assert last == len(places) - 1 and total == cheapest(places.tolist(), costs.tolist(), 2048)


@pytest.mark.parametrize("block", [packing.BLOCK, 3000])
def test_pieces_cover_every_document(spark, block):
    path = PATHS[1]
    tok, rnd = Tokenizer.from_file(path), random.Random(6)
    rows = [(k, t) for k, t in enumerate([*odd_texts(), words(rnd, 6000), ". ".join(words(rnd, 9) for _ in range(700))])]
    rows.append((None, "no id."))
    got = packing.pack(docs(spark, rows, extra=True), path, block=block).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    for k, t in rows:
        whole = [*reference(tok, t), 1]
        own = sorted(pieces[k], key=lambda r: r["start"])
        assert sum((r["ids"] for r in own), []) == whole
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in own)
        assert {r["doc_tokens"] for r in own} == {len(whole)}
    for rs in windows.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack(docs(spark, []), path).count() == 0
