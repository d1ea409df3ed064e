"""Passages of ``n`` words that occur elsewhere, whatever their length in bytes.

Words are runs of bytes between ASCII blanks; passages are equal if their words are,
however they are spaced. The anchor of a passage is the place of the smallest hash of
``GRAM`` words in it; it depends on the passage alone, so two equal passages have it
at the same place. Only anchors are exchanged at first, about one for 20 words; those
whose gram occurs once are set aside, and the passages around the others are
compared by their 128-bit digests.

Copies of a text are one document, each word of which is a repeat. Passages never
cross documents; overlaps within one document count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import discard, lists, map_arrow, written

GRAM = 8
#: Words whose anchors are found at a time; below 2^22, which the places are packed in.
PIECE = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)


def word_borders(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops) of the words."""
    code = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(code) + 2, np.int8)
    inside[1:-1] = ~((code == 32) | ((code >= 9) & (code <= 13)))
    turns = np.diff(inside)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def gram_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of the GRAM words from each place."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    step, factor = 1, 0x100000001B3
    while step < GRAM:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor % (1 << 64)
        step *= 2
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def anchors(words: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of each passage of ``n`` words, the gram hashes)."""
    passages, reach = len(words) - n + 1, n - GRAM + 1
    if passages < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h, out = gram_hashes(words), []
    for at in range(0, passages, PIECE):
        m = min(PIECE, passages - at)
        part = h[at:at + m + reach - 1]
        # leftmost smallest: the place breaks ties
        key, width = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64), 1
        while 2 * width <= reach:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < reach:
            key = np.minimum(key[:width - reach], key[reach - width:])
        out.append((key[:m] & _PLACE).astype(np.int64) + at)
    return np.concatenate(out), h


def _digest(text: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _anchored(df: DataFrame, n: int) -> DataFrame:
    """(digest, n_words, places, grams) of each row's anchors."""

    def make():
        def step(batch):
            digest, count, places, grams = [], [], [], []
            for x in batch.column(0):
                raw = (x.as_py() or "").encode()
                words = raw.split()
                at, h = anchors(words, n)
                at = np.unique(at)
                digest.append(hashlib.sha256(raw).digest())
                count.append(len(words))
                places.append(at)
                grams.append(h[at].view(np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array(count, pa.int64()), lists(places, pa.int64()), lists(grams, pa.int64())],
                ["digest", "n_words", "places", "grams"],
            )

        return step

    return map_arrow(df.select("text"), make, "digest binary, n_words long, places array<long>, grams array<long>")


def _passages(work: DataFrame, n: int) -> DataFrame:
    """(u, at, w, v): place and 128-bit digest of every passage whose anchor is in ``places``; ``work`` has the text."""

    def make():
        def step(batch):
            owner, where, what = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
            for i in range(batch.num_rows):
                words = batch.column(2)[i].as_py().encode().split()
                at = np.flatnonzero(np.isin(anchors(words, n)[0], batch.column(1)[i].values.to_numpy()))
                whole = b" ".join(words)
                stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                starts = np.concatenate([[0], stops[:-1]])
                what.append(b"".join(  # at once: one object a passage takes four times the digests
                    xxhash.xxh3_128_digest(whole[a:b]) for a, b in zip(starts[at].tolist(), (stops[at + n - 1] - 1).tolist())
                ))
                where.append(at)
                owner.append(np.full(len(at), batch.column(0)[i].as_py()))
            halves = np.frombuffer(b"".join(what), "<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(owner)), pa.array(np.concatenate(where).astype(np.int32)),
                 pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["u", "at", "w", "v"],
            )

        return step

    return map_arrow(work.select("u", "places", "text"), make, "u long, at int, w long, v long")


def _spans(work: DataFrame, n: int) -> DataFrame:
    """(digest, spans): bytes from the first to the last word of each passage that starts in ``starts``."""

    def make():
        def step(batch):
            out = []
            for starts, text in zip(batch.column(1), batch.column(2)):
                first, last = word_borders(text.as_py().encode())
                at = np.sort(starts.values.to_numpy())
                # passages that overlap are one span
                cut = np.flatnonzero(np.diff(at) >= n) + 1
                begin, end = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
                out.append([{"start": a, "stop": b} for a, b in zip(first[begin].tolist(), last[end + n - 1].tolist())])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                ["digest", "spans"],
            )

        return step

    return map_arrow(work.select("digest", "starts", "text"), make, "digest binary, spans array<struct<start: long, stop: long>>")


def with_texts(df: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """``wanted`` (digest, ...) with the text of that digest, once."""
    source = df.select(_digest(f"`{text}`").alias("digest"), F.col(f"`{text}`").alias("text")).filter("text <> ''")
    return source.join(wanted, "digest").dropDuplicates(["digest"])


def whole_texts(copied: DataFrame) -> DataFrame:
    """(digest, spans) that cover the whole text."""
    span = F.struct(F.lit(0).cast("long").alias("start"), F.lit(1 << 62).alias("stop"))
    return copied.select("digest", F.array(span).alias("spans"))


def repeated_passages(df: DataFrame, n: int, text: str = "text") -> DataFrame:
    """(digest, spans): per different text (its SHA-256) the bytes that repeated passages of ``n`` words cover."""
    return passage_spans(df, n, text)[0]


def passage_spans(df: DataFrame, n: int, text: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """The same, and the written tables it reads: ``discard`` them when it is written."""
    found = written(_anchored(df.select(F.col(f"`{text}`").alias("text")), n), "passage-anchors")
    # copies of a text repeat each of its passages
    copied = found.filter(F.col("n_words") >= n).groupBy("digest").count().filter("count > 1").select("digest")
    places = written(
        found.filter("size(places) > 0").dropDuplicates(["digest"])
        .select("digest", F.explode(F.arrays_zip("places", "grams")).alias("x"))
        .select("digest", F.col("x.places").alias("place"), F.col("x.grams").alias("gram")), "passage-grams",
    )
    twice = places.groupBy("gram").count().filter("count > 1").select("gram")
    shared = places.join(twice, "gram").groupBy("digest").agg(F.collect_list("place").alias("places"))
    # texts go by their row number from here on: it is written, so it stays
    texts = with_texts(df, shared, text).withColumn("u", F.monotonically_increasing_id())
    work = written(texts, "passage-work", compression="zstd")
    copied = written(copied, "passage-copies")
    discard(found, places)
    seen = written(_passages(work, n), "passages")
    start = F.struct("u", "at")
    repeats = seen.groupBy("w", "v").agg(F.min(start).alias("a"), F.max(start).alias("b")).filter("a <> b").select("w", "v")
    starts = written(
        seen.join(repeats, ["w", "v"]).groupBy("u").agg(F.collect_list(F.col("at").cast("long")).alias("starts")), "passage-starts",
    )
    discard(seen)
    partly = _spans(work.join(starts, "u"), n)
    spans = partly.join(copied, "digest", "left_anti").unionByName(whole_texts(copied))
    return spans, [work, copied, starts]
