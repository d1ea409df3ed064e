"""Records of quoted CSV files, read split by split.

A line break inside quotes does not end a record, so whether a line opens a record depends
on all quotes of the file before it. Only their parity matters, and parities add up:
tasks number the lines of their splits and count the lines with an odd number of quotes
("turns"); prefix sums over the few splits of each file give the turns before each split; a
line with an even number of turns before it opens a record. Lines that are a record
by themselves stay where they are; only pieces of longer records are exchanged, by
the number of their record. The text is read once and staged with its numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pulsegrid.session import materialize

LINES = "file string, block long, seq long, turns long, odd long, value string"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and the start of their split; a carriage return stays on its line."""
    return spark.read.option("lineSep", "\n").text(path).selectExpr(*LINE_COLUMNS)


#: What a text source, batch or stream, gives for ``number_lines``.
LINE_COLUMNS = ["_metadata.file_path AS file", "_metadata.file_block_start AS block", "value"]


def number_lines(lines: DataFrame) -> DataFrame:
    """Place of each line in its split, lines with odd quotes before it there, whether its own are odd."""

    def run(batches):
        key, seq, turns = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            files = batch.column(0).dictionary_encode()
            file, block = files.indices.to_numpy(), batch.column(1).to_numpy()
            odd = pc.count_substring(batch.column(2), '"').to_numpy().astype(np.int64) & 1
            seqs, before = np.arange(n), np.cumsum(odd) - odd
            starts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
            for a, b in zip([0, *starts.tolist()], [*starts.tolist(), n]):
                place = files.dictionary[file[a]].as_py(), block[a]
                if place != key:
                    key, seq, turns = place, 0, 0
                seqs[a:b] += seq - a
                before[a:b] += turns - before[a]
                seq, turns = seq + b - a, int(before[b - 1] + odd[b - 1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(seqs), pa.array(before), pa.array(odd), batch.column(2)],
                ["file", "block", "seq", "turns", "odd", "value"],
            )

    return lines.select("file", "block", "value").mapInArrow(run, LINES)


def records(numbered: DataFrame) -> DataFrame:
    """(file, block, seq, record, is_header): whole records, of staged numbered lines; empty ones are skipped.

    The header is the first record of its file. ``block`` and ``seq`` are the place of the record's first line.
    """
    filled = F.min(F.when(F.length(F.rtrim(F.col("value"))) > 0, F.col("seq")))
    splits = numbered.groupBy("file", "block").agg(F.sum("odd").alias("n"), filled.alias("filled"))
    in_file = Window.partitionBy("file")
    earlier = F.sum("n").over(in_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select(
        "file", "block", F.coalesce(earlier, F.lit(0)).alias("earlier"), "filled",
        F.min(F.when(F.col("filled").isNotNull(), F.col("block"))).over(in_file).alias("first"),
    )
    placed = numbered.join(splits, ["file", "block"]).select(
        "file", "block", "seq", "value", "odd", (F.col("earlier") + F.col("turns")).alias("before"),
        ((F.col("block") == F.col("first")) & (F.col("seq") == F.col("filled"))).alias("is_header"),
    )
    alone = (F.col("before") % 2 == 0) & (F.col("odd") == 0)
    whole = placed.filter(alone).select("file", "block", "seq", F.col("value").alias("record"), "is_header")
    piece = F.struct("block", "seq", "value", "is_header")
    pieces = F.sort_array(F.collect_list(piece))
    joined = (
        placed.filter(~alone).groupBy("file", F.floor(F.col("before") / 2).alias("number")).agg(pieces.alias("x"))
        .select(
            "file", F.col("x")[0]["block"].alias("block"), F.col("x")[0]["seq"].alias("seq"),
            F.array_join(F.transform("x", lambda p: p["value"]), "\n").alias("record"),
            F.col("x")[0]["is_header"].alias("is_header"),
        )
    )
    text = F.regexp_replace(F.when(F.col("is_header"), F.ltrim(F.col("record"), F.lit("﻿"))).otherwise(F.col("record")), "\r$", "")
    return whole.unionByName(joined).withColumn("record", text).filter("record <> ''")


#: A quoted part, with doubled quotes inside; possessive, so a long text costs one pass.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
FIELD = rf",({QUOTED}[^,]*+|[^,]*+)"
UNQUOTE = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'


def fields(record: Column) -> Column:
    """The values of one CSV record."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(FIELD), F.lit(1))

    def value(x: Column) -> Column:
        inner = F.replace(F.regexp_extract(x, UNQUOTE, 1), F.lit('""'), F.lit('"'))
        return F.when(x.rlike(UNQUOTE), F.concat(inner, F.regexp_extract(x, UNQUOTE, 2))).otherwise(x)

    return F.transform(raw, value)


def stage(lines: DataFrame, name: str | None = None) -> DataFrame:
    """The numbered lines, written: both passes over them read the staged files."""
    return materialize(number_lines(lines), "csv-lines", name=name)


def parsed(numbered: DataFrame) -> DataFrame:
    """(file, header, values, record) of all records but the headers; empty values are null."""
    found = records(numbered)
    heads = found.filter("is_header").select("file", F.transform(fields(F.col("record")), lambda x: F.trim(x)).alias("header"))
    rows = found.filter("not is_header").select("file", "record")
    # one header for each file; adaptive execution splits the rows of a big file
    return rows.join(heads, "file").select("file", "header", F.transform(fields(F.col("record")), lambda x: F.nullif(x, F.lit(""))).alias("values"), "record")
