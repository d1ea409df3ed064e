"""Removal of every byte that a ``LENGTH``-byte string occurring elsewhere covers.

The method is a distributed merge sort of suffixes that knows common prefixes: tasks
sort their suffixes into runs and front-code them (the bytes shared with the suffix
before are a number), the runs are exchanged, and a loser tree merges them,
comparing only behind the prefix that two suffixes are known to share. The sorted
order with its common-prefix lengths shows what repeats.

Only anchors enter the sort. The anchor of a start p is the place of the smallest
hash of ``GRAM`` bytes among the ``REACH`` places from p; it depends on nothing but
the string that starts at p, so two equal strings have their anchor at the same
place in them. Hence each repeated string shows up at two anchors whose next
``BLOCK`` bytes agree, and the steps are

1. per document: its digest, its anchors and the hashes of their blocks;
2. equal documents become one (each of its bytes is a repeat if it is long enough);
   anchors whose block occurs nowhere else are set aside;
3. the other anchors get their context, ``REACH`` bytes to the left and ``LENGTH`` to
   the right; equal contexts of a task are one entry with a count;
4. contexts with the same block meet in one partition, as front-coded runs, and are
   merged; for every shift s the entries that share s bytes to the left and
   LENGTH - s to the right are found from the two sorted orders, which gives each
   entry the furthest matching bytes on both sides, exactly;
5. a block with more than ``HOT`` different contexts is not gathered: each of its anchors
   is replaced by anchors of less reach (``CLOSER``), so with longer blocks, which go
   through steps 3 and 4 again. An anchor that sees shifts 0 to 256 becomes eight, 32
   bytes apart, that see shifts 0 to 32 and whose blocks have 368 bytes; the last are the
   starts themselves, whose block is the whole string and has one context.

Null and empty texts have no bytes. Repeated rows are copies of each other. Matches
never cross documents; overlaps within one document count.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import discard, fresh, lists, map_arrow, ship, written
from pulsegrid.llm.passages import passage_spans, whole_texts

LENGTH, REACH, GRAM = 400, 256, 16
BLOCK = LENGTH - REACH
#: Different contexts of one block that one task gathers at most.
HOT = 50_000
#: The reach of the anchors that replace those of crowded blocks.
CLOSER = {REACH: 32, 32: 0}
#: Entries that a run holds at most, and that a partition of blocks has on average.
RUN_ENTRIES, PART_ENTRIES = 1 << 16, 50_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- anchors -----------------------------------------------------------------
def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place."""
    h = raw.astype(np.uint64) + np.uint64(1)
    step, factor = 1, 0x100000001B3
    while step < GRAM:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor % (1 << 64)
        step *= 2
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def anchors(raw: bytes, piece: int = 1 << 20) -> np.ndarray:
    """The anchors of all starts p with LENGTH bytes from p on, increasing."""
    n = len(raw) - LENGTH + 1  # starts
    if n < 1:
        return np.empty(0, np.int64)
    whole, out = np.frombuffer(raw, np.uint8), []
    for at in range(0, n, piece):
        m = min(piece, n - at)
        h = gram_hashes(whole[at:at + m + REACH - 1 + GRAM - 1])
        # leftmost smallest: the place breaks ties
        key = (h & ~np.uint64((1 << 22) - 1)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step < REACH:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        out.append(np.unique((key[:m] & np.uint64((1 << 22) - 1)).astype(np.int64)) + at)
    return np.unique(np.concatenate(out))


# -- front-coded runs and their merge ----------------------------------------
def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known; doubles its stride, then halves it."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, step = known, 16
    while low + step < n and a[low:low + step] == b[low:low + step]:
        low += step
        step *= 2
    high = min(low + step, n)
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low if a[low:low + 1] != b[low:low + 1] else low + 1


def encode_run(entries: list[tuple[bytes, bytes, int]]) -> bytes:
    """Front-coded run of sorted (right, left, count); equal entries are merged."""
    out, last = [], b""
    packed: list[list] = []
    for right, left, count in sorted(entries):
        if packed and packed[-1][0] == right and packed[-1][1] == left:
            packed[-1][2] += count
        else:
            packed.append([right, left, count])
    for right, left, count in packed:
        p = shared_prefix(last, right)
        out.append(struct.pack("<HHHI", p, len(right) - p, len(left), count) + right[p:] + left)
        last = right
    return b"".join(out)


def decode_run(data: bytes):
    """(prefix shared with the entry before, right, left, count) in order."""
    at, last, size = 0, b"", struct.calcsize("<HHHI")
    while at < len(data):
        p, rest, side, count = struct.unpack_from("<HHHI", data, at)
        at += size
        last = last[:p] + data[at:at + rest]
        at += rest
        yield p, last, data[at:at + side], count
        at += side


def merge_runs(runs: list):
    """Loser tree over decoded runs: (prefix shared with the entry given out before, right, left, count).

    Every waiting entry knows its common prefix with the last winner. Of two entries
    the one that shares more with it is smaller; only if they share the same number are
    bytes compared, from there on. The loser keeps its prefix with the winner.
    """
    width = 1
    while width < len(runs):
        width *= 2
    runs = [iter(r) for r in runs] + [iter(())] * (width - len(runs))
    heads = [next(r, None) for r in runs]
    common = [0] * width  # with the entry that beat it last
    losers = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); both prefixes refer to the same earlier entry."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if common[a] != common[b]:
            return (a, b) if common[a] > common[b] else (b, a)
        p = shared_prefix(x[1], y[1], common[a])
        if x[1][p:p + 1] < y[1][p:p + 1] or (x[1] == y[1] and (x[2], a) <= (y[2], b)):
            common[b] = p
            return a, b
        common[a] = p
        return b, a

    def start(node: int) -> int:
        if node >= width:
            return node - width
        w, losers[node] = play(start(2 * node), start(2 * node + 1))
        return w

    winner = start(1) if width > 1 else 0
    while heads[winner] is not None:
        _, right, left, count = heads[winner]
        yield common[winner], right, left, count
        heads[winner] = next(runs[winner], None)
        if heads[winner] is not None:
            common[winner] = heads[winner][0]  # it follows the winner in its run
        node = (winner + width) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


# -- what repeats among merged contexts --------------------------------------
def extents(rights: list[bytes], lefts: list[bytes], counts: list[int], prefix: np.ndarray, reach: int = REACH):
    """For entries sorted by right: the most bytes to the left and to the right of matching strings (-1: none).

    ``prefix[i]`` is what entry i shares with entry i - 1.
    """
    n = len(rights)
    reach_l, reach_r = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    len_l = np.array([len(x) for x in lefts])
    len_r = np.array([len(x) for x in rights])
    back = [x[::-1] for x in lefts]
    order = np.array(sorted(range(n), key=back.__getitem__), np.int64)
    left_prefix = np.zeros(n, np.int64)
    for k in range(1, n):
        left_prefix[k] = shared_prefix(back[order[k - 1]], back[order[k]])
    group_l = np.empty(n, np.int64)
    for s in range(reach + 1):
        need = LENGTH - s
        can = np.flatnonzero((len_l >= s) & (len_r >= need))
        if not len(can):
            continue
        group_r = np.cumsum(prefix < need)
        group_l[order] = np.cumsum(left_prefix < s)
        key = group_r[can] * (n + 1) + group_l[can]
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        hit = can[(times[which] > 1) | (counts[can] > 1)]
        reach_l[hit] = s
        reach_r[hit] = np.maximum(reach_r[hit], need)
    return reach_l, reach_r


# -- steps -------------------------------------------------------------------
def _profiles(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: k, its digest and size, its anchors and the hashes of their blocks."""
    kind = df.schema[key].dataType.simpleString()

    def make():
        def step(batch):
            digest, sizes, places, hashes = [], [], [], []
            for x in batch.column(1):
                raw = (x.as_py() or "").encode()
                at = anchors(raw)
                digest.append(hashlib.sha256(raw).digest())
                sizes.append(len(raw))
                places.append(at.tolist())
                hashes.append([xxhash.xxh64_intdigest(raw[a:a + BLOCK]) - (1 << 63) for a in at.tolist()])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digest, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(places, pa.list_(pa.int64())), pa.array(hashes, pa.list_(pa.int64()))],
                ["k", "digest", "n_bytes", "places", "blocks"],
            )

        return step

    given = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return map_arrow(given, make, f"k {kind}, digest binary, n_bytes long, places array<long>, blocks array<long>")


def _entries(work: DataFrame, reach: int) -> DataFrame:
    """(digest, place, name, block) of every anchor in ``work``; the name is the digest of its context."""

    def make():
        def step(batch):
            names = []
            for places, text in zip(batch.column(1), batch.column(3)):
                raw = text.as_py().encode()
                names.append([_name(*context(raw, a, reach)) for a in places.as_py()])
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(names, pa.list_(pa.binary()))], ["digest", "places", "blocks", "names"]
            )

        return step

    named = map_arrow(
        work.select("digest", "places", "blocks", "text"), make,
        "digest binary, places array<long>, blocks array<long>, names array<binary>",
    )
    x = F.col("x")
    return named.select("digest", F.explode(F.arrays_zip("places", "blocks", "names")).alias("x")).select(
        "digest", x["places"].alias("place"), x["names"].alias("name"), x["blocks"].alias("block")
    )


def _runs(work: DataFrame, parts: int, crowded: set[int], reach: int) -> DataFrame:
    """(part, run): sorted, front-coded runs of a batch of documents for each partition of blocks."""

    def make():
        def step(batch):
            runs: dict[int, list] = {}
            held, owners, out = 0, [], []
            for places, blocks, text in zip(*batch.columns):
                raw = text.as_py().encode()
                for a, b in zip(places.as_py(), blocks.as_py()):
                    if b not in crowded:
                        left, right = context(raw, a, reach)
                        runs.setdefault(b % parts, []).append((right, left, 1))
                        held += 1
                        if held == RUN_ENTRIES:  # coded they take little
                            owners += runs
                            out += map(encode_run, runs.values())
                            runs.clear()
                            held = 0
            owners += runs
            out += map(encode_run, runs.values())
            return pa.RecordBatch.from_arrays([pa.array(owners, pa.int32()), pa.array(out, pa.binary())], ["part", "run"])

        return step

    return map_arrow(work.select("places", "blocks", "text"), make, "part int, run binary")


def context(raw: bytes, at: int, reach: int = REACH) -> tuple[bytes, bytes]:
    return raw[max(0, at - reach):at], raw[at:at + LENGTH]


def _name(left: bytes, right: bytes) -> bytes:
    return hashlib.md5(struct.pack("<H", len(left)) + left + right).digest()


def _merged(runs: DataFrame, reach: int) -> DataFrame:
    """(name, reach_l, reach_r) of the entries that repeat; each partition's runs meet in one task."""
    block = LENGTH - reach

    def merge(table: pa.Table) -> pa.Table:
        names, lefts_out, rights_out = [], [], []
        rights: list[bytes] = []
        lefts: list[bytes] = []
        counts: list[int] = []
        prefix: list[int] = []

        def settle():
            if len(rights) > 1 or (counts and counts[0] > 1):
                first = np.array(prefix, np.int64)
                first[0] = 0
                a, b = extents(rights, lefts, np.array(counts), first, reach)
                for k in np.flatnonzero(a >= 0).tolist():
                    names.append(_name(lefts[k], rights[k]))
                    lefts_out.append(int(a[k]))
                    rights_out.append(int(b[k]))
            for x in (rights, lefts, counts, prefix):
                x.clear()

        many = [decode_run(x.as_py()) for x in table.column("run")]
        for p, right, left, count in merge_runs(many):
            if p < block and len(rights) >= 4096:  # no string of what follows matches what came before
                settle()
            if rights and right == rights[-1] and left == lefts[-1]:
                counts[-1] += count
            else:
                rights.append(right)
                lefts.append(left)
                counts.append(count)
                prefix.append(p)
        settle()
        return pa.table({
            "name": pa.array(names, pa.binary()), "reach_l": pa.array(lefts_out, pa.int64()),
            "reach_r": pa.array(rights_out, pa.int64()),
        })

    ship(runs.sparkSession)
    return runs.groupBy("part").applyInArrow(merge, "name binary, reach_l long, reach_r long")


def _closer(work: DataFrame, crowded: set[int], reach: int, closer: int) -> DataFrame:
    """(digest, places, blocks, text): the anchors of crowded blocks as anchors of the reach ``closer``, with their blocks.

    An anchor sees the strings that start at most its reach before it; the new ones see the same strings.
    """
    block = LENGTH - closer

    def make():
        def step(batch):
            which, places, hashes = [], [], []
            for i in range(batch.num_rows):
                old = [a for a, b in zip(batch.column(1)[i].as_py(), batch.column(2)[i].as_py()) if b in crowded]
                if not old:
                    continue
                raw = batch.column(3)[i].as_py().encode()
                found = {a - s for a in old for s in range(0, reach - closer + 1, closer or 1)}
                at = sorted(a for a in found if 0 <= a <= len(raw) - block)
                which.append(i)
                places.append(np.array(at, np.int64))
                hashes.append(np.array([xxhash.xxh64_intdigest(raw[a:a + block]) - (1 << 63) for a in at], np.int64))
            if not which:
                return None
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which)), lists(places, pa.int64()), lists(hashes, pa.int64()),
                 batch.column(3).take(pa.array(which))], ["digest", "places", "blocks", "text"],
            )

        return step

    return map_arrow(
        work.select("digest", "places", "blocks", "text"), make,
        "digest binary, places array<long>, blocks array<long>, text string",
    )


def _found(work: DataFrame, hot: int, reach: int = REACH) -> tuple[DataFrame, list[DataFrame]]:
    """(digest, place, reach_l, reach_r) of the anchors in ``work`` that repeat, and the written tables it reads."""
    entries = written(_entries(work, reach), "suffix-entries")
    crowded = set()
    if reach:
        names = entries.groupBy("block", "name").count()
        # one block in ``hot`` entries at most
        crowded = {r[0] for r in names.groupBy("block").count().filter(F.col("count") > hot).select("block").collect()}
    parts = max(1, int(work.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // PART_ENTRIES))
    found = entries.join(_merged(_runs(work, parts, crowded, reach), reach), "name").select(
        "digest", "place", "reach_l", "reach_r"
    )
    if not crowded:
        return found, [entries]
    found = written(found, "suffix-found")
    discard(entries)
    closer = CLOSER[reach]
    nearer = written(_closer(work, crowded, reach, closer), "suffix-work", compression="zstd")
    more, tables = _found(nearer, hot, closer)
    return found.unionByName(more), [found, nearer, *tables]


def repeated_spans(
    df: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT
) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(documents, spans, tables): per row k, digest, n_bytes, copies; (digest, text, spans) of texts partly repeated.

    Both read the written ``tables``, which are to be discarded when they are written themselves.
    """
    profiles = written(_profiles(df, key, text), "suffix-profiles")
    distinct = profiles.groupBy("digest").agg(F.count("*").alias("copies"), F.min("k").alias("rep"))
    blocks = (
        profiles.dropDuplicates(["digest"]).select("digest", F.explode(F.arrays_zip("places", "blocks")).alias("x"))
        .select("digest", F.col("x.places").alias("place"), F.col("x.blocks").alias("block"))
    )
    blocks = written(blocks, "suffix-blocks")
    twice = blocks.groupBy("block").count().filter("count > 1").select("block")
    wanted = (
        blocks.join(twice, "block").groupBy("digest")
        .agg(F.sort_array(F.collect_list(F.struct("place", "block"))).alias("x"))
        .select("digest", F.col("x.place").alias("places"), F.col("x.block").alias("blocks"))
    )
    # the text of one row for each of them
    chosen = wanted.join(distinct, "digest").select("digest", "places", "blocks", "copies", F.col("rep").alias("of"))
    source = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"))
    work = written(
        source.join(
            chosen,
            F.col("k").eqNullSafe(F.col("of")) & (F.unhex(F.sha2(F.col("text"), 256)) == F.col("digest")),
        ).select("digest", "places", "blocks", "copies", "text").dropDuplicates(["digest"]),
        "suffix-work", compression="zstd",
    )
    discard(blocks)
    found, tables = _found(work, hot)
    spans = found.groupBy("digest").agg(
        F.sort_array(F.collect_set(
            F.struct((F.col("place") - F.col("reach_l")).alias("start"), (F.col("place") + F.col("reach_r")).alias("stop"))
        )).alias("spans")
    )
    documents = profiles.join(distinct, "digest").select("k", "digest", "n_bytes", "copies")
    return documents, work.select("digest", "text").join(spans, "digest"), [profiles, work, *tables]


def cut_spans(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(bytes left, bytes removed, maximal removed runs) for spans sorted by start."""
    kept, at, removed, runs, stop = [], 0, 0, 0, -1
    for start, end in spans:
        if start > stop:
            kept.append(raw[at:start])
            runs += 1
            stop = start
        if end > stop:
            removed += end - stop
            stop = at = end
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans widened to the borders of the UTF-8 characters they cut in two."""
    out = []
    for start, stop in spans:
        while start < len(raw) and raw[start] & 0xC0 == 0x80:
            start -= 1
        while stop < len(raw) and raw[stop] & 0xC0 == 0x80:
            stop += 1
        out.append((start, stop))
    return out


def _cut(partly: DataFrame) -> DataFrame:
    """(digest, kept, n_removed, n_spans) from (digest, text, spans)."""

    def make():
        def step(batch):
            found = [
                cut_spans(text.as_py().encode(), [(x["start"], x["stop"]) for x in spans.as_py()])
                for text, spans in zip(batch.column(1), batch.column(2))
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.binary()),
                 pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64())],
                ["digest", "kept", "n_removed", "n_spans"],
            )

        return step

    return map_arrow(
        partly.select("digest", "text", "spans"), make, "digest binary, kept binary, n_removed long, n_spans long"
    )


def removal_report(df: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """Per row: the key, n_bytes, n_removed, n_spans and kept_sha256 (of the remaining bytes)."""
    documents, partly, _ = repeated_spans(df, key, text, hot)
    cut = _cut(partly).select(
        F.col("digest").alias("of"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    return documents.join(cut, F.col("digest") == F.col("of"), "left").select(
        F.col("k").alias(key), "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )


def dedup_substrings(
    df: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT, passage_words: int | None = None,
) -> DataFrame:
    """``df`` with the repeated bytes taken out of ``text``; a character cut in two goes as a whole.

    With ``passage_words`` repeated passages of so many words go too, also those shorter than ``LENGTH`` bytes.
    """
    documents, partly, tables = repeated_spans(df, key, text, hot)
    lone = documents.filter((F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)).select("digest").distinct()
    # the spans are small: what was written to find them goes before the next search begins
    spans = written(partly.select("digest", "spans").unionByName(whole_texts(lone)), "substring-spans")
    discard(*tables)
    if passage_words:
        found, tables = passage_spans(df, passage_words, text)
        found = written(found, "passage-spans")
        discard(*tables)
        spans = spans.unionByName(found)
    of, changed, found = fresh(df, "digest_of"), fresh(df, "changed"), fresh(df, "spans")
    spans = spans.groupBy(F.col("digest").alias(changed)).agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias(found))
    own = F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))
    joined = df.withColumn(of, own).join(spans, F.col(of) == F.col(changed), "left")
    place, last = df.columns.index(text), len(df.columns)

    def make():
        def step(batch):
            columns = batch.columns[:last]
            if batch.column(last).null_count < batch.num_rows:
                new = columns[place].to_pylist()
                for i in np.flatnonzero(batch.column(last).is_valid().to_numpy(zero_copy_only=False)).tolist():
                    raw = (new[i] or "").encode()
                    cut = whole_characters(raw, [(x["start"], x["stop"]) for x in batch.column(last)[i].as_py()])
                    new[i] = cut_spans(raw, cut)[0].decode()
                columns[place] = pa.array(new, columns[place].type)
            return pa.RecordBatch.from_arrays(columns, batch.schema.names[:last])

        return step

    return map_arrow(joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col(found)), make, df.schema)
