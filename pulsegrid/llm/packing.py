"""Packing of a token stream into windows, in document order.

The documents in the order of their key form one stream, each with an end id.
Windows of at most ``window`` ids are cut from it at document ends (free), at
sentence ends (``SENTENCE_COST``) or, inside very long sentences, every
``HARD_STEP`` ids (``HARD_COST``). A window costs its padding: what it lacks to
``window``, or nothing if its length is one of the powers of two in ``EXACT``.
Dynamic programming finds the cheapest cuts: the best predecessor of a cut is
the least of (cost so far + place) over the last ``window`` ids, kept in a
monotone queue, so each cut is handled in constant amortised time.

Each task takes one range of keys and solves blocks of ``block`` ids; the last
window of a block is opened again by the next block, so only the end of a task
costs an incomplete window. A null or empty text is its end id alone. Rows with
equal keys stay together in the order of their text's hash; null keys come first.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import lists, ship
from pulsegrid.llm.tokens import encoder

SENTENCE_COST, HARD_COST, HARD_STEP = 8, 64, 128
EXACT = (512, 1024)
BLOCK = 1 << 18


def cuts_of(ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Admissible cuts in a document of ``length`` ids, its end last, and what each costs."""
    inner = ends[(ends > 0) & (ends < length)]
    marks = np.concatenate([[0], inner, [length]])
    gaps = np.diff(marks)
    hard = [np.arange(marks[k] + HARD_STEP, marks[k + 1], HARD_STEP) for k in np.flatnonzero(gaps > 2 * HARD_STEP)]
    places = np.concatenate([inner, *hard, [length]]).astype(np.int64)
    costs = np.full(len(places), SENTENCE_COST, np.int64)
    costs[len(inner):] = HARD_COST
    costs[-1] = 0
    order = np.argsort(places, kind="stable")
    return places[order], costs[order]


def best_cuts(places: np.ndarray, costs: np.ndarray, window: int) -> list[int]:
    """Indices of the cheapest cuts; ``places`` increases from 0 and ends where the stream ends."""
    count = len(places)
    exact = []
    for size in EXACT:
        if size < window:
            at = np.searchsorted(places, places - size)
            exact.append(np.where(places[np.minimum(at, count - 1)] == places - size, at, -1).tolist())
    where, cost = places.tolist(), costs.tolist()
    best, back, key = [0] * count, [0] * count, [0] * count
    queue: deque[int] = deque()
    for j in range(1, count):
        i = j - 1
        value = key[i] = best[i] + where[i]
        while queue and key[queue[-1]] >= value:
            queue.pop()
        queue.append(i)
        low = where[j] - window
        while where[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        least = key[i] + window - where[j]
        for near in exact:
            k = near[j]
            if k >= 0 and best[k] < least:
                least, i = best[k], k
        best[j], back[j] = least + cost[j], i
    out, j = [], count - 1
    while j:
        out.append(j)
        j = back[j]
    return out[::-1]


class Packer:
    """Takes documents in order and gives out finished pieces."""

    def __init__(self, window: int, block: int, first_sequence: int):
        self.window, self.block, self.sequence = window, block, first_sequence
        #: (key, ids, start of what is left of it, cuts and their costs from the document's start)
        self.docs: list[tuple] = []
        self.size = 0

    def add(self, key, ids: np.ndarray, ends: np.ndarray) -> list[tuple]:
        self.docs.append((key, ids, 0, *cuts_of(ends, len(ids))))
        self.size += len(ids)
        return self.flush(False) if self.size >= self.block else []

    def flush(self, final: bool) -> list[tuple]:
        """Pieces (key, ids of the document, start, length, sequence, offset)."""
        if not self.docs:
            return []
        places, costs, base = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
        for _, ids, start, cuts, price in self.docs:
            later = cuts > start
            places.append(cuts[later] - start + base)
            costs.append(price[later])
            base += len(ids) - start
        places, costs = np.concatenate(places), np.concatenate(costs)
        chosen = places[best_cuts(places, costs, self.window)].tolist()
        if not final and len(chosen) > 1:
            chosen.pop()  # the next block continues from the last cut but one
        out, base, k, begun, left = [], 0, 0, 0, []
        for doc in self.docs:
            key, ids, start = doc[:3]
            at, end = base, base + len(ids) - start
            while at < end and k < len(chosen):
                stop = min(end, chosen[k])
                out.append((key, ids, start + at - base, stop - at, self.sequence, at - begun))
                at = stop
                if at == chosen[k]:
                    begun, k, self.sequence = at, k + 1, self.sequence + 1
            if at < end:
                left.append((key, ids, start + at - base, *doc[3:]))
            base = end
        self.docs, self.size = left, base - begun
        return out


def pack(
    df: DataFrame, path: str, window: int = 2048, end_id: int = 1, key: str = "doc_id",
    text: str = "text", block: int = BLOCK, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset and its ids."""
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + ", ids array<int>" * with_ids
    )
    names = [x.split("`")[1] if "`" in x else x.split()[0] for x in schema.split(", ")]
    source = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    ordered = source.repartitionByRange("k", F.xxhash64("t")).sortWithinPartitions("k", F.xxhash64("t"))

    def run(batches):
        from pyspark import TaskContext

        enc = encoder(path)
        packer = Packer(window, block, TaskContext.get().partitionId() << 32)

        def rows(pieces):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in pieces], key_type),
                    pa.array([x[2] for x in pieces], pa.int64()),
                    pa.array([x[3] for x in pieces], pa.int64()),
                    pa.array([zlib.crc32(x[1][x[2]:x[2] + x[3]].tobytes()) for x in pieces], pa.int64()),
                    pa.array([len(x[1]) for x in pieces], pa.int64()),
                    pa.array([x[4] for x in pieces], pa.int64()),
                    pa.array([x[5] for x in pieces], pa.int64()),
                    *([lists([x[1][x[2]:x[2] + x[3]] for x in pieces], pa.int32())] if with_ids else []),
                ],
                names,
            )

        last = np.array([end_id], "<i4")
        for batch in batches:
            key_type = batch.schema.types[0]
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, ends = enc.encode_with_ends(value.as_py())
                pieces = packer.add(name, np.concatenate([ids, last]), ends)
                if pieces:
                    yield rows(pieces)
        if packer.docs:
            yield rows(packer.flush(True))

    ship(df.sparkSession)
    return ordered.mapInArrow(run, schema)
