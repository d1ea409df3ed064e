"""Shards of near-equal bytes by histogram sort, with DataFrame functions only.

Rows are ordered by the key (hash of the text, doc_id), so equal texts lie side by
side. The wanted splitters are the places in that order where k/n of all bytes
lie below. They are found by counting: a round cuts the open key ranges by their
next ``RADIX`` bits, counts the exact bytes in each bucket on all partitions at once
and keeps only the buckets in which a wanted place lies, until a border lies
within ``tolerance`` of it (a share of the mean shard) or the bucket is one key.
Only these counts come to the driver: at most 2^RADIX for each splitter. Then
every row is compared with the splitters and exchanged once.

Copies of one text are cut apart only where the tolerance demands it. Rows that
agree in hash and doc_id stay in one shard. A null text has no bytes (its size is
``ROW_BYTES``), a null doc_id sorts first; an empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.frames import fresh, written

ROW_BYTES, TOLERANCE, RADIX = 8, 0.01, 12
#: Rows of one numbering task, about.
SLOT_ROWS = 50_000
LEAST, MOST = -(1 << 63), (1 << 63) - 1


@dataclass
class Bucket:
    """Keys (k0, k1) with ``word >> shift == value``; k0 is fixed where the word is k1."""

    first: int | None
    shift: int
    value: int
    below: int  # exact bytes below the bucket
    targets: list[int]

    @property
    def next_shift(self) -> int:
        return max(0, self.shift - RADIX)

    def holds(self) -> Column:
        word = "k0" if self.first is None else "k1"
        inside = F.lit(True) if self.shift == 64 else F.shiftright(word, self.shift) == F.lit(self.value)
        return inside if self.first is None else inside & (F.col("k0") == F.lit(self.first))

    def cut(self) -> Column:
        return F.shiftright("k0" if self.first is None else "k1", self.next_shift)

    def start(self, value: int) -> tuple[int, int] | None:
        """The least key of the cut ``value``; None if it lies above all keys."""
        at = value << self.next_shift
        if self.first is None:
            return (at, LEAST) if at <= MOST else None
        if at <= MOST:
            return self.first, at
        return (self.first + 1, LEAST) if self.first < MOST else None


def splitters(keyed: DataFrame, n: int, tolerance: float = TOLERANCE) -> list[tuple[int, int] | None]:
    """``n - 1`` least keys of the shards 1 to n - 1; ``keyed`` has the longs k0, k1, size."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    slack = int(tolerance * total / n)
    targets = [k * total // n for k in range(1, n)]
    found: dict[int, tuple[int, int] | None] = {}
    open_ = [Bucket(None, 64, 0, 0, sorted(set(targets)))] if total else []
    while open_:
        which, cut = F.lit(None).cast("int"), F.lit(None).cast("long")
        for i, b in enumerate(open_):
            which, cut = F.when(b.holds(), i).otherwise(which), F.when(b.holds(), b.cut()).otherwise(cut)
        counts: list[list] = [[] for _ in open_]
        rows = (
            keyed.select(which.alias("i"), cut.alias("cut"), "k0", "k1", "size").filter("i IS NOT NULL")
            .groupBy("i", "cut")
            .agg(F.sum("size").alias("bytes"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("k0", "k1") for f in (F.min, F.max)])
        )
        for r in rows.collect():
            counts[r["i"]].append(r)
        open_ = [x for b, c in zip(open_, counts) for x in _narrow(b, sorted(c, key=lambda r: r["cut"]), slack, found)]
    return [found.get(t) for t in targets]


def _narrow(b: Bucket, counts: list, slack: int, found: dict) -> list[Bucket]:
    """Settle the targets that a border of the counted cuts meets; what stays open is cut on."""
    later, below, todo = [], b.below, list(b.targets)
    for r in counts:
        above = below + r["bytes"]
        inside = [t for t in todo if t < above]
        todo = [t for t in todo if t >= above]
        single = r["min_k0"] == r["max_k0"] and r["min_k1"] == r["max_k1"]
        rest = []
        for t in inside:
            if t - below <= slack or single and t - below <= above - t:
                found[t] = b.start(r["cut"])
            elif above - t <= slack or single:
                found[t] = b.start(r["cut"] + 1)
            else:
                rest.append(t)
        if rest:
            one_hash = b.first is None and r["min_k0"] == r["max_k0"]
            later.append(
                Bucket(r["min_k0"], 64, 0, below, rest) if one_hash
                else Bucket(b.first, b.next_shift, r["cut"], below, rest)
            )
        below = above
    return later


def key_columns(df: DataFrame, key: str, text: str) -> tuple[Column, Column, Column]:
    """k0, k1 and the size of a row."""
    whole = df.schema[key].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    number = F.col(f"`{key}`").cast("long") if whole else F.xxhash64(f"`{key}`")
    size = F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long") + ROW_BYTES
    return F.xxhash64(f"`{text}`"), F.coalesce(number, F.lit(LEAST)), size


def shard_by_bytes(
    df: DataFrame, n: int, key: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE,
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """``df`` with ``shard`` (0 to n - 1, near-equal bytes), ``slot`` (gapless from 0) and ``size``."""
    k0, k1, size = key_columns(df, key, text)
    keyed = written(df.select(k0.alias("k0"), k1.alias("k1"), size.alias("size")), "shard-keys")
    bounds = splitters(keyed, n, tolerance)
    per_shard = max(1, -(-keyed.count() // (n * slot_rows)))

    def shard(a: Column, b: Column) -> Column:
        past = [
            ((a > x[0]) | ((a == x[0]) & (b >= x[1]))).cast("int") for x in bounds if x is not None
        ]
        return sum(past, F.lit(0)).cast("int")

    def sub(a: Column, b: Column) -> Column:
        return F.pmod(F.xxhash64(a, b), F.lit(per_shard)).cast("int")

    places = Window.partitionBy("of_shard").orderBy("of_sub").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        keyed.groupBy(shard(F.col("k0"), F.col("k1")).alias("of_shard"), sub(F.col("k0"), F.col("k1")).alias("of_sub"))
        .count()
        .select("of_shard", "of_sub", F.coalesce(F.sum("count").over(places), F.lit(0)).alias("first_slot"))
    )
    names = {c: fresh(df, c) for c in ("shard", "slot", "size", "sub_shard", "k0", "k1")}
    at = {c: F.col(f"`{x}`") for c, x in names.items()}
    numbered = (
        df.withColumns({names["k0"]: k0, names["k1"]: k1, names["size"]: size})
        .withColumns({names["shard"]: shard(at["k0"], at["k1"]), names["sub_shard"]: sub(at["k0"], at["k1"])})
        .withColumn(
            names["slot"],
            F.row_number().over(
                Window.partitionBy(at["shard"], at["sub_shard"]).orderBy(at["k0"], at["k1"])
            ).cast("long") - 1,
        )
    )
    return (
        numbered.join(first, (at["shard"] == F.col("of_shard")) & (at["sub_shard"] == F.col("of_sub")))
        .withColumn(names["slot"], at["slot"] + F.col("first_slot"))
        .drop(names["k0"], names["k1"], names["sub_shard"], "of_shard", "of_sub", "first_slot")
    )
