"""Removal of repeated word windows by recompression.

A text is a sequence of words (runs of bytes between ASCII blanks). Recompression
shortens sequences in rounds that depend on nothing but their symbols: maximal runs of
one symbol become a symbol, then in each phase a coin per symbol says left or right, and
every left symbol followed by a right one becomes a pair symbol. Names are mixed from the
names below, so all tasks name equal runs and pairs alike; a symbol longer than the
round's limit takes no further part. For each symbol we keep the stretch of words that
fully determines it: where that lies inside a repeated stretch, the symbol is the same in
all copies ("interior").

Spark rounds name the symbols of all texts together:

1. texts become symbols of about ``n`` / 6 words; names held by one text only are breaks.
   A window of ``n`` words that contains all that determines a break cannot occur in
   another text and is out; texts without any other window are out;
2. the texts left are compressed further between their breaks, to symbols of ``n`` words
   and more. Such a symbol that also starts in a text with a smaller key is a
   repeat as a whole; no window inside it has to be looked at;
3. the windows left (outside those symbols, without a break) are hashed and meet those of
   all other texts; the smallest key is the owner of a window;
4. every removed stretch is compared byte by byte with its owner's text. If two differing
   stretches ever share a name, all is done again with other names.

Equal texts are one text: each row of it but those with its smallest key repeats it whole.
Null keys come after all others and are not smaller than each other; rows with equal keys
are not smaller than each other either. Null and empty texts have no words.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import discard, lists, map_arrow, written

WORDS = 50
#: Phases of a round of recompression; the first round stops at symbols of n * SHARE words.
PHASES, SHARE = 9, 0.16
#: Bytes of a text that are split into words at once.
PIECE = 1 << 22
#: Names to try; a second one is only needed if differing stretches share a 64-bit name.
SEEDS = 8
FAR = 1 << 30
_MIX, _MIX2, _FACTOR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), 0x2545F4914F6CDD1D
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# -- words ---------------------------------------------------------------------
def words_in(raw: bytes):
    """Lists of the words, one for each piece of the text; no word is cut."""
    at = 0
    while at < len(raw):
        found = _BLANK.search(raw, at + PIECE) if len(raw) - at > PIECE else None
        stop = found.start() if found else len(raw)
        yield raw[at:stop].split()
        at = stop


def hashes_of(words: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n symbols from each place, by doubling."""
    if len(h) < n:
        return h[:0]
    out, done, part, step, factor = None, 0, h, 1, _FACTOR
    while step <= n:
        if n & step:
            m = len(h) - done - step + 1
            out = part[:m] if out is None else out[:m] * np.uint64(factor) + part[done:done + m]
            done += step
        if 2 * step <= n:
            part = part[:-step] * np.uint64(factor) + part[step:]
        step, factor = 2 * step, factor * factor % (1 << 64)
    return _mixed(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX2
    return h ^ (h >> np.uint64(32))


def _named(h: np.ndarray) -> np.ndarray:
    """Mixed, and never 0: that is the name of breaks and of the ends of texts."""
    return np.maximum(_mixed(h), np.uint64(1))


# -- recompression of a sequence -------------------------------------------------
class Sequence:
    """Symbols with their words, bytes and the words [low, high) that determine each of them."""

    def __init__(self, name, words, size, low, high):
        self.name, self.words, self.size, self.low, self.high = name, words, size, low, high

    def runs(self) -> Sequence:
        """Every maximal run of a symbol becomes one symbol; what stands beside it says that it is maximal."""
        s, last = self.name, len(self.name) - 1
        same = (s[1:] == s[:-1]) & (s[1:] != 0)
        at = np.flatnonzero(np.concatenate([[True], ~same]))
        end = np.concatenate([at[1:], [len(s)]])
        before, behind = np.maximum(at - 1, 0), np.minimum(end, last)
        low = np.minimum(np.minimum.reduceat(self.low, at), np.minimum(self.low[before], self.low[behind]))
        high = np.maximum(np.maximum.reduceat(self.high, at), np.maximum(self.high[before], self.high[behind]))
        name, many = s[at], end - at > 1
        name[many] = _named(name[many] * _MIX + (end - at)[many].astype(np.uint64))
        return Sequence(name, np.add.reduceat(self.words, at), np.add.reduceat(self.size, at), low, high)

    def pairs(self, phase: int, limit: int) -> Sequence:
        """Left symbols followed by right ones become one; a symbol left alone also depends on what stands there."""
        s, low, high = self.name, self.low, self.high
        coin = _mixed(s ^ np.uint64(phase * 0x1F123BB5 + 99)) & np.uint64(1)
        active = (s != 0) & (self.words <= limit)
        left, right = active & (coin == 0), active & (coin == 1)
        new = [x.copy() for x in (s, self.words, self.size, low, high)]
        for at, by in ((np.flatnonzero(left[:-1] & ~right[1:]), 1), (np.flatnonzero(right[1:] & ~left[:-1]) + 1, -1)):
            new[3][at], new[4][at] = np.minimum(low[at], low[at + by]), np.maximum(high[at], high[at + by])
        p = np.flatnonzero(left[:-1] & right[1:])
        new[0][p] = _named(s[p] * _MIX + _mixed(s[p + 1] + np.uint64(phase)))
        new[1][p] += self.words[p + 1]
        new[2][p] += self.size[p + 1]
        new[3][p], new[4][p] = np.minimum(low[p], low[p + 1]), np.maximum(high[p], high[p + 1])
        keep = np.ones(len(s), bool)
        keep[p + 1] = False
        return Sequence(*(x[keep] for x in new))

    def compress(self, limit: int, first: int) -> Sequence:
        out = self.runs()
        for phase in range(first, first + PHASES):
            out = out.pairs(phase, limit)
        return out


def _joined(parts: list[tuple], ends: bool = True) -> tuple[Sequence, np.ndarray]:
    """One sequence of many texts' (name, words, size, before, behind), an end between them, and the places of the ends.

    ``before`` and ``behind`` are how many words beside the symbol determine it (FAR: the end of the text does).
    """
    zero = np.zeros(1, np.int32)
    far = np.full(1, FAR, np.int32)
    columns = []
    for c, fill in ((0, np.zeros(1, np.uint64)), (1, zero), (2, zero), (3, far), (4, far)):
        columns.append(np.concatenate([fill, *(x for p in parts for x in (p[c], fill))]))
    name, words, size, before, behind = columns
    stop = np.cumsum(words)
    counts = np.array([len(p[0]) + 1 for p in parts], np.int64)
    low = np.where(before >= FAR, -FAR, stop - words - before).astype(np.int64)
    high = np.where(behind >= FAR, FAR, stop + behind).astype(np.int64)
    return Sequence(name, words, size, low, high), np.concatenate([[0], np.cumsum(counts)])


def _parts(seq: Sequence):
    """Per text (name, words, size, before, behind) of its symbols again."""
    ends = np.flatnonzero((seq.name == 0) & (seq.words == 0))
    stop = np.cumsum(seq.words)
    far = (seq.low < 0) | (seq.high >= FAR)
    before = np.where(far, FAR, np.minimum(stop - seq.words - seq.low, FAR)).astype(np.int32)
    behind = np.where(far, FAR, np.minimum(seq.high - stop, FAR)).astype(np.int32)
    for a, b in zip((ends[:-1] + 1).tolist(), ends[1:].tolist()):
        yield seq.name[a:b], seq.words[a:b], seq.size[a:b], before[a:b], behind[a:b]


def open_windows(words: np.ndarray, before: np.ndarray, behind: np.ndarray, breaks: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of n words that contain no break with all that determines it, as (from, to) pairs."""
    stop = np.cumsum(words, dtype=np.int64)
    total = int(stop[-1]) if len(stop) else 0
    if total < n:
        return np.empty((0, 2), np.int64)
    b = np.flatnonzero(breaks & (before < FAR) & (behind < FAR))
    low, high = stop[b] - words[b] - before[b], stop[b] + behind[b]
    fits = high - low <= n
    turn = np.zeros(total - n + 2, np.int64)
    np.add.at(turn, np.clip(high[fits] - n, 0, total - n + 1), 1)
    np.add.at(turn, np.clip(low[fits] + 1, 0, total - n + 1), -1)
    free = np.concatenate([[0], (np.cumsum(turn[:-1]) == 0).astype(np.int8), [0]])
    step = np.diff(free)
    return np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], axis=1)


# -- steps ---------------------------------------------------------------------
_SYMBOLS = "names array<long>, words array<int>, sizes array<int>, before array<int>, behind array<int>"


def _profiles(df: DataFrame, key: str, text: str, n: int, seed: int) -> DataFrame:
    """Per row: k, digest of the text, n_words, digest of its words, symbols of the first round (of long enough texts)."""
    kind = df.schema[key].dataType.simpleString()

    def make():
        def step(batch):
            digest, count, kept, parts = [], [], [], []
            for x in batch.column(1):
                raw = (x.as_py() or "").encode()
                own, total, sha = [], 0, hashlib.sha256()
                for words in words_in(raw):
                    if words:
                        sha.update(b" " * (total > 0) + b" ".join(words))
                        total += len(words)
                        size = np.fromiter(map(len, words), np.int32, len(words)) + np.int32(1)
                        own.append((hashes_of(words, seed), size))
                digest.append(hashlib.sha256(raw).digest())
                count.append(total)
                kept.append(sha.hexdigest())
                if total < n:
                    own = []
                name = np.maximum(np.concatenate([np.empty(0, np.uint64), *(a for a, _ in own)]), np.uint64(1))
                size = np.concatenate([np.empty(0, np.int32), *(b for _, b in own)])
                none = np.zeros(len(name), np.int32)
                parts.append((name, none + np.int32(1), size, none, none))
            found = list(_parts(_joined(parts)[0].compress(max(1, int(n * SHARE)), 0)))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digest, pa.binary()), pa.array(count, pa.int64()), pa.array(kept, pa.string()),
                 lists([p[0].view(np.int64) for p in found], pa.int64()),
                 *[lists([p[c] for p in found], pa.int32()) for c in range(1, 5)]],
                ["k", "digest", "n_words", "kept_sha256", "names", "words", "sizes", "before", "behind"],
            )

        return step

    given = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    rows = map_arrow(given, make, f"k {kind}, digest binary, n_words long, kept_sha256 string, {_SYMBOLS}")
    return rows.withColumn("u", F.monotonically_increasing_id())


def _order(k: str = "k", u: str | None = None):
    """Sorts null keys last."""
    return F.struct(F.col(k).isNull().alias("none"), F.col(k).alias("k"), *([F.col(u).alias("u")] if u else []))


def _longer(symbols: DataFrame, n: int) -> DataFrame:
    """Texts with an open window: their open windows and their symbols of n words or more (second round)."""
    kind = symbols.schema["k"].dataType.simpleString()
    wide, ints = pa.list_(pa.int64()), pa.list_(pa.int32())

    def make():
        def step(batch):
            columns = [batch.column(c) for c in range(3, 8)]
            rows, parts, windows = [], [], []
            for i in range(batch.num_rows):
                name, words, size, before, behind = (c[i].values.to_numpy() for c in columns)
                shared = np.zeros(len(name), bool)
                held = batch.column(8)[i]
                if held.is_valid:
                    shared[held.values.to_numpy()] = True
                found = open_windows(words, before, behind, ~shared, n)
                if len(found):
                    rows.append(i)
                    windows.append(found)
                    parts.append((np.where(shared, name.view(np.uint64), np.uint64(0)), words, size, before, behind))
            if not rows:
                return None
            names, starts, lengths, places = [], [], [], []
            for name, words, size, _, _ in _parts(_joined(parts)[0].compress(n, 100)):
                long = np.flatnonzero((name != 0) & (words >= n))
                names.append(name[long].view(np.int64))
                starts.append((np.cumsum(words, dtype=np.int64) - words)[long])
                lengths.append(words[long].astype(np.int32))
                places.append((np.cumsum(size, dtype=np.int64) - size)[long])
            return pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(rows)) for c in range(3)), lists([w[:, 0] for w in windows], pa.int64()),
                 lists([w[:, 1] for w in windows], pa.int64()), lists(names, pa.int64()), lists(starts, pa.int64()),
                 lists(lengths, pa.int32()), lists(places, pa.int64())],
                ["u", "k", "digest", "froms", "tos", "names", "starts", "lengths", "places"],
            )

        return step

    given = symbols.select("u", "k", "digest", "names", "words", "sizes", "before", "behind", "held")
    return map_arrow(
        given, make, f"u long, k {kind}, digest binary, froms array<long>, tos array<long>, names array<long>,"
        " starts array<long>, lengths array<int>, places array<long>",
    )


def _whole_symbols(level: DataFrame) -> DataFrame:
    """(u, starts, lengths, owners, places): the long symbols of each text that also start in a text with a smaller key."""
    x = F.col("x")
    each = level.select("u", "k", F.explode(F.arrays_zip("names", "starts", "lengths", "places")).alias("x")).select(
        "u", "k", x["names"].alias("name"), x["starts"].alias("start"), x["lengths"].alias("length"), x["places"].alias("place")
    )
    first = each.groupBy("name").agg(
        F.min(F.struct(_order(), "u", "place")).alias("o"), F.max(_order()).alias("last")
    ).filter(F.col("last") > F.col("o.col1")).select("name", "o")
    return (
        each.join(first, "name").filter(_order() > F.col("o.col1")).groupBy("u")
        .agg(F.sort_array(F.collect_list(F.struct("start", "length", F.col("o.u").alias("of"), F.col("o.place").alias("at")))).alias("whole"))
    )


def _normal(raw: bytes) -> bytes:
    return b" ".join([b" ".join(words) for words in words_in(raw) if words])


def _free(froms, tos, whole, n: int) -> np.ndarray:
    """Starts of the open windows that lie in none of the long repeated symbols."""
    at = np.concatenate([np.arange(a, b) for a, b in zip(froms, tos)])
    if not whole:
        return at
    turn = np.zeros(int(tos[-1]) + 1, np.int64)
    for x in whole:
        turn[min(x["start"], len(turn) - 1)] += 1
        turn[min(x["start"] + x["length"] - n + 1, len(turn) - 1)] -= 1
    return at[np.cumsum(turn)[at] == 0]


def _starts(words: list[bytes]) -> np.ndarray:
    """Byte offsets of the words in the text with single blanks; one more for its end and a blank."""
    return np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])


def _windows(work: DataFrame, n: int, seed: int) -> DataFrame:
    """(w, k, u, place): hash and byte offset of the first of each different free window of a text."""
    kind = work.schema["k"].dataType.simpleString()

    def make():
        def step(batch):
            hashes, places, rows = [], [], []
            for i in range(batch.num_rows):
                froms, tos = (batch.column(c)[i].values.to_numpy() for c in (2, 3))
                at = _free(froms, tos, batch.column(4)[i].as_py(), n)
                if not len(at):
                    continue
                words = batch.column(5)[i].as_py().encode().split(b" ")
                w, first = np.unique(window_hashes(hashes_of(words, seed), n)[at], return_index=True)
                hashes.append(w.view(np.int64))
                places.append(_starts(words)[at[first]])
                rows.append(np.full(len(w), i))
            if not rows:
                return None
            of = pa.array(np.concatenate(rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hashes)), batch.column(1).take(of), batch.column(0).take(of), pa.array(np.concatenate(places))],
                ["w", "k", "u", "place"],
            )

        return step

    return map_arrow(work.select("u", "k", "froms", "tos", "whole", "normal"), make, f"w long, k {kind}, u long, place long")


def stretches(at: np.ndarray, of: np.ndarray, there: np.ndarray, starts: np.ndarray, n: int) -> list[tuple]:
    """(first word, last word, owner, byte offset there) of runs of windows that follow each other here and there."""
    if not len(at):
        return []
    here = starts[at]
    new = (np.diff(at) > 1) | (np.diff(of) != 0) | (np.diff(here) != np.diff(there))
    begin = np.concatenate([[0], np.flatnonzero(new) + 1])
    end = np.concatenate([begin[1:], [len(at)]]) - 1
    return list(zip(at[begin].tolist(), (at[end] + n).tolist(), of[begin].tolist(), there[begin].tolist()))


def needed(found: list[tuple]) -> list[tuple]:
    """Stretches that together cover all of ``found``; what lies inside those before it is left out."""
    out, stop = [], -1
    for x in sorted(found, key=lambda x: (x[0], -x[1])):
        if x[1] > stop:
            out.append(x)
            stop = x[1]
    return out


def _cut(work: DataFrame, n: int, seed: int) -> DataFrame:
    """(u, n_removed, kept, checks): the words left, and per removed stretch its owner, the offset there and its bytes."""
    check = pa.list_(pa.struct([("of", pa.int64()), ("at", pa.int64()), ("body", pa.string())]))

    def make():
        def step(batch):
            gone_out, kept, checks = [], [], []
            for i in range(batch.num_rows):
                whole, hits = batch.column(3)[i].as_py(), batch.column(4)[i]
                words = batch.column(5)[i].as_py().encode().split(b" ")
                starts = _starts(words)
                found = [(x["start"], x["start"] + x["length"], x["of"], x["at"]) for x in whole or ()]
                if hits.is_valid:
                    w, of, there = (hits.values.field(c).to_numpy() for c in range(3))
                    order = np.argsort(w)
                    w, of, there = w[order], of[order], there[order]
                    at = _free(batch.column(1)[i].values.to_numpy(), batch.column(2)[i].values.to_numpy(), whole, n)
                    mine = window_hashes(hashes_of(words, seed), n)[at].view(np.int64)
                    k = np.minimum(np.searchsorted(w, mine), len(w) - 1)
                    hit = w[k] == mine
                    found += stretches(at[hit], of[k[hit]], there[k[hit]], starts, n)
                found, raw = needed(found), b" ".join(words)
                gone = np.zeros(len(words), bool)
                for a, b, _, _ in found:
                    gone[a:b] = True
                gone_out.append(int(gone.sum()))
                kept.append(b" ".join([words[j] for j in np.flatnonzero(~gone).tolist()]).decode())
                checks.append([{"of": of, "at": at, "body": raw[starts[a]:starts[b] - 1].decode()} for a, b, of, at in found])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(gone_out, pa.int64()), pa.array(kept, pa.string()), pa.array(checks, check)],
                ["u", "n_removed", "kept", "checks"],
            )

        return step

    return map_arrow(
        work.select("u", "froms", "tos", "whole", "hits", "normal"), make,
        "u long, n_removed long, kept string, checks array<struct<of: long, at: long, body: string>>",
    )


def _with_texts(df: DataFrame, key: str, text: str, level: DataFrame) -> DataFrame:
    """``level`` with ``normal``, the words of each text with single blanks between them."""
    place = len(level.columns)

    def make():
        def step(batch):
            said = [_normal(x.as_py().encode()).decode() for x in batch.column(place)]
            return pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(said, pa.string())], [*batch.schema.names[:place], "normal"])

        return step

    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("t"), F.unhex(F.sha2(F.col(f"`{text}`"), 256)).alias("sha"))
    joined = source.join(level, F.col("sha").eqNullSafe(F.col("digest")) & F.col("key").eqNullSafe(F.col("k")))
    # repeated rows of one key
    one = joined.dropDuplicates(["u"]).select(*level.columns, "t")
    return map_arrow(one, make, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in level.schema) + ", normal string")


def _attempt(df: DataFrame, key: str, text: str, n: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    profiles = written(_profiles(df, key, text, n, seed), "recompression-profiles", compression="zstd")
    firsts = profiles.groupBy("digest").agg(F.min(_order("k", "u")).alias("first"))
    firsts = written(firsts.select("digest", F.col("first.k").alias("first_k"), F.col("first.u").alias("u")), "recompression-firsts")
    symbols = written(
        profiles.filter(F.col("n_words") >= n).drop("n_words", "kept_sha256").join(firsts.select("u"), "u", "left_semi"),
        "recompression-symbols", compression="zstd",
    )
    each = symbols.select("u", F.posexplode("names").alias("place", "name"))
    shared = each.groupBy("name").agg(F.min("u").alias("a"), F.max("u").alias("b")).filter("a <> b").select("name")
    held = each.join(shared, "name").groupBy("u").agg(F.collect_list("place").alias("held"))
    level = written(_longer(symbols.join(held, "u", "left"), n), "recompression-level", compression="zstd")
    plain = level.join(_whole_symbols(level), "u", "left").select("u", "k", "digest", "froms", "tos", "whole")
    work = written(_with_texts(df, key, text, plain), "recompression-texts", compression="zstd")
    discard(symbols, level)
    windows = written(_windows(work, n, seed), "recompression-windows")
    owners = windows.groupBy("w").agg(
        F.min(F.struct(_order(), "u", "place")).alias("o"), F.max(_order()).alias("last")
    ).filter(F.col("last") > F.col("o.col1")).select("w", "o")
    hits = windows.join(owners, "w").filter(_order() > F.col("o.col1")).groupBy("u").agg(
        F.collect_list(F.struct("w", F.col("o.u").alias("of"), F.col("o.place").alias("at"))).alias("hits")
    )
    changed = work.join(hits, "u", "left").filter("hits is not null or whole is not null")
    cut = written(_cut(changed, n, seed), "recompression-cut", compression="zstd")
    claims = cut.select(F.explode("checks").alias("x")).select("x.of", "x.at", "x.body")
    said = F.col("body").cast("binary")
    there = F.substring(F.col("normal").cast("binary"), F.col("at").cast("int") + 1, F.octet_length("body"))
    wrong = claims.join(work.select(F.col("u").alias("owner"), "normal"), F.col("of") == F.col("owner")).filter(there != said)
    right = wrong.isEmpty()
    discard(windows, work)
    return (profiles, firsts, cut) if right else None


def repeated_windows(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS) -> DataFrame:
    """Per row: the key, n_words, n_removed, kept and kept_sha256.

    Removed is each word in a window of ``n`` words whose words also start in a row with a
    smaller key; windows are those of the input. ``kept`` has the other words with single blanks,
    null where nothing is removed; ``kept_sha256`` is the SHA-256 of all kept words so joined.
    """
    for seed in range(SEEDS):
        found = _attempt(df, key, text, n, seed)
        if found:
            break
    else:
        raise RuntimeError("words that differ share their names under every seed")
    profiles, firsts, cut = found
    rows = profiles.select("k", "digest", "n_words", "kept_sha256").join(firsts, "digest").join(cut.drop("checks"), "u", "left")
    copy = ~F.col("k").eqNullSafe(F.col("first_k")) & (F.col("n_words") >= n)
    kept = F.when(copy, F.lit("")).otherwise(F.col("kept"))
    return rows.select(
        F.col("k").alias(key), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        kept.alias("kept"), F.coalesce(F.sha2(kept, 256), F.col("kept_sha256")).alias("kept_sha256"),
    )
