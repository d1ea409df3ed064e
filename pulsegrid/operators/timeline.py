"""Ordered-in-time operators whose groups stay bounded.

A node can own a third of all rows, so nothing here sorts "all rows of one
key". Every sort runs on (key, chunk of time); what has to cross a chunk border
travels as a summary row per chunk. Rows are either folded to one per (key,
second), where only the latest counts (``per_second``), or all kept in the order of
their time and ties (``timed``); the latter use shorter chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.functions.scalars import epoch

DAY = 86400
#: Chunk of operators that keep every row.
DENSE = 600


def timed(df: DataFrame, keys: list[str], time: str, tie: list[str], values: list[str]) -> DataFrame:
    """Every row with a key and a time: keys, ``sec``, ``ord`` (time, then ties) and the values."""
    known = df.dropna(subset=[*keys, time])
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([time, *tie])])
    return known.select(*keys, epoch(F.col(time)).alias("sec"), order.alias("ord"), *values)


def per_second(
    df: DataFrame, keys: list[str], time: str, tie: list[str], values: list[str]
) -> DataFrame:
    """One row per (keys, second): the latest one, ties by ``tie``. Adds ``sec``.

    The maximum of a struct combines on the map side, so replays and bursts of
    one key never meet in one task. Rows without a key or a time are left out.
    """
    order = [F.col(time)] + [F.col(t) for t in tie]
    known = df.filter(F.col(time).isNotNull())
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    return (
        known.groupBy(*keys, epoch(F.col(time)).alias("sec"))
        .agg(F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *values)).alias("m"))
        .select(*keys, "sec", *[F.col(f"m.{v}").alias(v) for v in values])
    )


def with_previous(
    df: DataFrame, keys: list[str], values: list[str], chunk_s: int = DAY, order: str = "sec", following: bool = False,
) -> DataFrame:
    """Add ``prev_sec`` and ``prev_<value>`` of the row before, per key; with ``following`` of the row behind.

    Rows of a key are ordered by ``order``, which grows with ``sec``. The row before
    the first one of a chunk is the last one of the previous non-empty chunk, taken
    from the summaries.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col("sec") / F.lit(chunk_s)))
    carried = F.struct(*dict.fromkeys([order, "sec", *values]))
    step, edge = (F.lead, F.min) if following else (F.lag, F.max)
    by_chunk = Window.partitionBy(*keys, "_chunk").orderBy(order)
    local = chunked.withColumn("_p", step(carried).over(by_chunk))
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk")
    border = (
        chunked.groupBy(*keys, "_chunk")
        .agg(edge(carried).alias("_edge"))
        .select(*keys, "_chunk", step("_edge").over(over_chunks).alias("_beyond"))
    )
    return (
        local.join(border, [*keys, "_chunk"], "left")
        .withColumn("_p", F.coalesce("_p", "_beyond"))
        .select(
            *df.columns,
            F.col("_p.sec").alias("prev_sec"),
            *[F.col(f"_p.{v}").alias(f"prev_{v}") for v in values],
        )
    )


def state_runs(
    df: DataFrame, keys: list[str], state: str, chunk_s: int = DAY, order: str = "sec", nth: int | None = None
) -> DataFrame:
    """Maximal runs of equal ``state``: keys, state, run_start, run_end, polls.

    Rows of a key are ordered by ``order``, which grows with ``sec``; where it is
    another column, the run's first value of it is returned too. With ``nth`` the
    time of the run's n-th row comes as ``nth_at``. Runs are built inside each chunk;
    only the first and the last run of a chunk can continue elsewhere, so at most
    two rows per chunk take part in the merge across chunks.
    """
    own = Window.partitionBy(*keys, "_chunk").orderBy(order)
    same = F.col(state).eqNullSafe(F.lag(state).over(own))
    first = F.row_number().over(own) == 1
    marked = df.withColumn("_chunk", F.floor(F.col("sec") / F.lit(chunk_s))).withColumn(
        "_new", (first | ~same).cast("int")
    )
    numbered = marked.withColumn("_run", F.sum("_new").over(own))
    if nth:
        place = F.row_number().over(Window.partitionBy(*keys, "_chunk", "_run").orderBy(order))
        numbered = numbered.withColumn("_early", F.when(place <= nth, F.struct(order, "sec")))
    else:
        numbered = numbered.withColumn("_early", F.lit(None).cast("int"))
    sums = [F.min("sec"), F.max("sec"), F.count(F.lit(1)), F.min(order), F.collect_list("_early")]
    names = ["_s", "_e", "_n", "_o", "_early"]
    pieces = numbered.groupBy(*keys, "_chunk", "_run", state).agg(*[x.alias(n) for x, n in zip(sums, names)])
    chunk_all = Window.partitionBy(*keys, "_chunk")
    pieces = pieces.withColumn("_last_run", F.max("_run").over(chunk_all))
    inner = pieces.filter((F.col("_run") > 1) & (F.col("_run") < F.col("_last_run")))
    outer = pieces.filter((F.col("_run") == 1) | (F.col("_run") == F.col("_last_run")))
    by_piece = Window.partitionBy(*keys).orderBy("_chunk", "_run")
    joins_previous = F.col(state).eqNullSafe(F.lag(state).over(by_piece)) & (
        F.col("_chunk") != F.lag("_chunk").over(by_piece)
    )
    ends = [F.min("_s"), F.max("_e"), F.sum("_n"), F.min("_o"), F.flatten(F.collect_list("_early"))]
    merged = (
        outer.withColumn("_brk", (~F.coalesce(joins_previous, F.lit(False))).cast("int"))
        .withColumn("_grp", F.sum("_brk").over(by_piece))
        .groupBy(*keys, "_grp", state)
        .agg(*[x.alias(n) for x, n in zip(ends, names)])
    )
    columns = [*keys, state, *names]
    extra = [] if order == "sec" else [F.col("_o").alias(order)]
    if nth:
        extra.append(F.timestamp_seconds(F.get(F.sort_array("_early"), nth - 1)["sec"]).alias("nth_at"))
    return (
        merged.select(*columns)
        .unionByName(inner.select(*columns))
        .select(
            *keys,
            state,
            F.timestamp_seconds("_s").alias("run_start"),
            F.timestamp_seconds("_e").alias("run_end"),
            F.col("_n").alias("polls"),
            *extra,
        )
    )


def sums_within(
    points: DataFrame,
    facts: DataFrame,
    keys: list[str],
    sums: list[str],
    before_s: int,
    after_s: int,
    chunk_s: int = 3600,
) -> DataFrame:
    """For each (keys, sec) of ``points``: sums over facts in [sec-before, sec+after].

    Each fact second adds its sums where it enters the range and takes them off
    where it leaves; a running total over (key, chunk) gives the answer. No pair
    of rows is ever built, whatever the density.
    """
    width = max(chunk_s, before_s + after_s + 1)
    start = F.col("sec") - F.lit(after_s)
    stop = F.col("sec") + F.lit(before_s) + F.lit(1)
    spread = facts.withColumn("from_s", start).withColumn("to_s", stop).withColumn(
        "chunk",
        F.explode(
            F.sequence(F.floor(F.col("from_s") / width), F.floor((F.col("to_s") - 1) / width))
        ),
    )
    chunk_start = F.col("chunk") * F.lit(width)
    enters = spread.select(
        *keys, "chunk", F.greatest(F.col("from_s"), chunk_start).alias("at"), *sums
    )
    leaves = spread.filter(F.col("to_s") < chunk_start + width).select(
        *keys, "chunk", F.col("to_s").alias("at"), *[(-F.col(s)).alias(s) for s in sums]
    )
    changes = (
        enters.unionByName(leaves)
        .groupBy(*keys, "chunk", "at")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .withColumn("ask", F.lit(0))
    )
    asks = points.select(
        *keys,
        F.floor(F.col("sec") / width).alias("chunk"),
        F.col("sec").alias("at"),
        *[F.lit(0).cast(facts.schema[s].dataType).alias(s) for s in sums],
        F.lit(1).alias("ask"),
    )
    running = (
        Window.partitionBy(*keys, "chunk")
        .orderBy("at", "ask")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        changes.unionByName(asks)
        .select(*keys, "at", "ask", *[F.sum(s).over(running).alias(s) for s in sums])
        .filter("ask = 1")
        .select(*keys, F.col("at").alias("sec"), *sums)
    )


def distinct_seconds(df: DataFrame, keys: list[str], time: Column) -> DataFrame:
    """The (keys, sec) pairs that occur, nulls left out."""
    seconds = df.select(*keys, epoch(time).alias("sec")).dropna()
    return seconds.distinct()
