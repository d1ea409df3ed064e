"""SimHash near-duplicates by pivot distance tables.

A document's fingerprint has 64 bits, each the majority of that bit over the
XXH64 hashes of its three-word shingles. Two fingerprints link if they differ in
at most ``MAX_BITS`` bits; components of links are the groups.

Distances to many reference fingerprints are computed once per different
fingerprint. For each base reference there is also its complement on each of
``BLOCKS`` blocks of bits, and the difference of the two distances is the distance
inside that block. As at most three bits differ, at least two of five blocks do
not, and two fingerprints that agree on a block have the same distances in it to
every reference: pairs are sought only among fingerprints whose coordinates agree
in two blocks. A pair is discarded when some coordinate of the whole table differs
by more than ``MAX_BITS`` (the triangle inequality), and what survives is verified
bit by bit. No link is lost: every step is a necessary condition.

Copies meet in one fingerprint first. A cell of many fingerprints is cut into
chunks and each pair of chunks is a group of its own, so groups are bounded and
each gives out at most a spanning forest of its links, never all pairs.

Texts are lower-cased in A-Z only; null, empty and blank texts have the
fingerprint zero, which links like any other. Repeated rows stay.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.components import components
from pulsegrid.llm.frames import append, fresh, map_arrow, with_schema, written

MAX_BITS, BLOCKS, SHINGLE, SEED = 3, 5, 3, 42
#: Base references; with their complements per block the table has six times as many columns.
PIVOTS = 16
#: Fingerprints of a chunk of a large cell.
CHUNK = 512
#: Blocks of 13, 13, 13, 13 and 12 bits.
MASKS = np.array([((1 << min(13, 64 - 13 * b)) - 1) << (13 * b) for b in range(BLOCKS)], np.uint64)
BASES = np.array([xxhash.xxh64_intdigest(f"pivot {k}", SEED) for k in range(PIVOTS)], np.uint64)
REFERENCES = np.concatenate([BASES, *(BASES ^ m for m in MASKS)])


# -- fingerprints ------------------------------------------------------------
def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Unsigned XXH64 of every shingle of ``size`` words; a text of fewer words is one shingle, without a word none."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = len(words) - size + 1
    pieces = map(whole.__getitem__, map(slice, starts[:n].tolist(), (ends[size - 1:] - 1).tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, n)


def fingerprint(text: str | None) -> int:
    """Signed, as Spark's longs are."""
    return majority(shingle_hashes(text))


def majority(h: np.ndarray) -> int:
    """The bits set in over half the hashes, signed; of no hash zero."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 4096):
        part = h[k:k + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` without the text, with the fingerprint as a long."""
    rest = [c for c in df.columns if c != text]
    name = fresh(df.select(*[F.col(f"`{c}`") for c in rest]), out)
    last = len(rest)

    def make():
        def step(batch):
            found = [fingerprint(x.as_py()) for x in batch.column(last)]
            kept = pa.RecordBatch.from_arrays(batch.columns[:last], batch.schema.names[:last])
            return append(kept, **{name: pa.array(found, pa.int64())})

        return step

    given = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(fresh(df, "text_in")))
    return map_arrow(given, make, with_schema(df.select(*[F.col(f"`{c}`") for c in rest]), f"`{name}` long"))


# -- pivot tables ------------------------------------------------------------
def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each reference."""
    return np.bitwise_count(fp.astype(np.uint64)[:, None] ^ REFERENCES[None, :]).astype(np.int8)


def block_coordinates(table: np.ndarray) -> np.ndarray:
    """(row, block, pivot): distance inside the block, from the distances to the pivot and its complement."""
    base = table[:, :PIVOTS].astype(np.int16)
    turned = table[:, PIVOTS:].reshape(len(table), BLOCKS, PIVOTS)
    size = np.bitwise_count(MASKS).astype(np.int16)[None, :, None]
    return ((base[:, None, :] - turned + size) // 2).astype(np.int8)


PAIRS = list(combinations(range(BLOCKS), 2))


def _cells(distinct: DataFrame) -> DataFrame:
    """(cell, fp): one row per pair of blocks; fingerprints within reach share a cell."""

    def make():
        def step(batch):
            fp = batch.column(0).to_numpy()
            inside = block_coordinates(pivot_table(fp.view(np.uint64)))
            keys = np.empty((len(fp), len(PAIRS)), np.int64)
            for k, (x, y) in enumerate(PAIRS):
                rows = np.concatenate([inside[:, x], inside[:, y]], axis=1)
                keys[:, k] = [
                    xxhash.xxh64_intdigest(r.tobytes(), k) - (1 << 63) for r in rows
                ]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(fp, len(PAIRS)))], ["cell", "fp"]
            )

        return step

    return map_arrow(distinct, make, "cell long, fp long")


def forest(fp: np.ndarray, other: np.ndarray | None = None, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``fp``, or between ``fp`` and ``other`` and within them."""
    every = fp if other is None else np.concatenate([fp, other])
    table = pivot_table(every.view(np.uint64)).astype(np.int16)
    unsigned = every.view(np.uint64)
    root, out = np.arange(len(every)), []
    for i in range(len(every) - 1):
        rest = np.flatnonzero(root[i + 1:] != root[i]) + i + 1
        # the coordinate-wise lower bound discards; a few columns first, as most pairs fall there
        rest = rest[np.abs(table[rest, :4] - table[i, :4]).max(1) <= bits]
        rest = rest[np.abs(table[rest] - table[i]).max(1) <= bits]
        for j in rest[np.bitwise_count(unsigned[rest] ^ unsigned[i]) <= bits].tolist():
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                out.append((int(every[i]), int(every[j])))
    return out


def links(distinct: DataFrame, chunk: int = CHUNK, bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect whatever is connected at ``bits``; ``distinct`` has the long ``fp``.

    Beyond ``MAX_BITS`` this holds for pairs that share a cell, that is, agree in two blocks.
    """
    cells = written(_cells(distinct), "simhash-cells")
    sizes = cells.groupBy("cell").count().filter("count > 1").withColumn(
        "chunks", F.ceil(F.col("count") / chunk).cast("int")
    ).withColumnRenamed("cell", "of")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = (
        cells.join(sizes, F.col("cell") == F.col("of"))
        .select("cell", "fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("cell", "fp", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    )
    groups = dealt.groupBy("cell", "p", "q").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)

    def make():
        def step(batch):
            found = [x for fps in batch.column(0) for x in forest(np.unique(fps.values.to_numpy()), bits=bits)]
            a, b = (list(x) for x in zip(*found)) if found else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        return step

    return map_arrow(groups.select("fps"), make, "a long, b long").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(key, fingerprint long, component): the smallest key reachable over links; null keys are kept."""
    marked = written(fingerprints(df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"))), "simhash-fingerprints")
    distinct = written(
        marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("k").alias("least")), "simhash-distinct"
    )
    member = components(links(distinct.select("fp"), chunk))
    rooted = distinct.join(member, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(roots, "root").select("fp", "component_id")
    return marked.join(named, F.col("fingerprint") == F.col("fp")).select(
        F.col("k").alias(key), "fingerprint", "component_id"
    )


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` whose key is the smallest of its group."""
    found = near_duplicates(df, key, text).filter(F.col(key).eqNullSafe(F.col("component_id")))
    kept = found.select(F.col(key).alias("kept_key")).distinct()
    return df.join(kept, F.col(f"`{key}`").eqNullSafe(F.col("kept_key")), "left_semi")
