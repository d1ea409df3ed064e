"""Joins to a side with one row per key, safe for hot keys on the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "left") -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key.

    ``on`` pairs a left with a right column; right keys do not come out. The
    right side usually ends in a window or an aggregate on the same key and would
    enter the join without an exchange, but adaptive execution splits a hot
    partition only between two exchanges. Joining on the key and its hash asks
    for one on both sides, so a key with a third of the left rows is spread over
    many tasks. A small right side is still broadcast, by its size.
    """
    types = {theirs: left.schema[ours].dataType for ours, theirs in on}
    names = {theirs: f"_key{i}" for i, (_, theirs) in enumerate(on)}
    # hashes agree only on equal types; a right key the left type cannot hold matches nothing
    same_type = {
        theirs: F.col(theirs).try_cast(kind)
        for theirs, kind in types.items()
        if right.schema[theirs].dataType != kind
    }
    typed = right.withColumns(same_type) if same_type else right
    keyed = typed.withColumnsRenamed(names).withColumn("_hash", F.xxhash64(*names.values()))
    condition = F.xxhash64(*[left[ours] for ours, _ in on]) == keyed["_hash"]
    for ours, theirs in on:
        condition &= left[ours] == keyed[names[theirs]]
    return left.join(keyed, condition, how).drop(*names.values(), "_hash")
