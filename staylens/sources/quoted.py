"""CSV files whose quoted fields hold line breaks, read by many tasks per file.

Whether a line begins a record depends on all quotes before it. Each task counts
them from the start of its own byte range; what the ranges before it add is one bit,
a prefix sum over ranges. So a line is stored with both answers, and the bit picks
one. Only lines of records over several lines are grouped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.session import cut_lineage
from staylens.sources import files

_LINES = "file string, block bigint, line bigint, odd boolean, odd_after boolean, even_start bigint, odd_start bigint, value string"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one range after another, each with the parity of the range's quotes
    before and after it, and the last line at or before it that follows an even and an
    odd number of quotes (-1: none in this range)."""
    here, line, parity, last = None, 0, 0, [-1, -1]
    for batch in batches:
        names = batch.column(0).to_pylist()
        blocks = batch.column(1).to_numpy(zero_copy_only=False)
        quotes = pc.count_substring(batch.column(2), '"').to_numpy(zero_copy_only=False).astype(np.int64)
        changes = [0] + [i for i in range(1, len(names)) if blocks[i] != blocks[i - 1] or names[i] != names[i - 1]] + [len(names)]
        for a, b in zip(changes, changes[1:]):
            if a == b:
                continue
            if (names[a], blocks[a]) != here:
                here, line, parity, last = (names[a], blocks[a]), 0, 0, [-1, -1]
            after = (parity + np.cumsum(quotes[a:b])) % 2
            before = np.concatenate([[parity], after[:-1]])
            numbers = np.arange(line, line + b - a)
            starts = [np.maximum.accumulate(np.where(before == p, numbers, last[p])) for p in (0, 1)]
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(numbers), pa.array(before == 1), pa.array(after == 1), pa.array(starts[0]), pa.array(starts[1]), part.column(2)],
                ["file", "block", "line", "odd", "odd_after", "even_start", "odd_start", "value"],
            )
            line, parity, last = line + b - a, int(after[-1]), [int(starts[0][-1]), int(starts[1][-1])]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record, is_first)``: the records of all files below ``path``.

    Lines end with ``\\n`` or ``\\r\\n``; line breaks inside quotes stay as they are.
    A quote that is never closed takes all lines to the end of its file into one record,
    as any reader of such files does.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    ranges = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    lines = cut_lineage(ranges.mapInArrow(_numbered, _LINES))

    by_range = lines.groupBy("file", "block").agg(
        F.max_by("odd_after", "line").alias("odd_total"), F.max("even_start").alias("even_last"), F.max("odd_start").alias("odd_last")
    )
    # A row per byte range.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_range.withColumn("carry", F.coalesce(F.sum(F.col("odd_total").cast("int")).over(before), F.lit(0)) % 2 == 1)
    last = F.when(F.col("carry"), F.col("odd_last")).otherwise(F.col("even_last"))
    owner = F.last(F.when(last >= 0, F.struct("block", last.alias("line"))), ignorenulls=True).over(before)
    carried = cut_lineage(carried.select("file", "block", "carry", owner.alias("owner")))

    joined = lines.join(carried, ["file", "block"]).select(
        "file", "block", "line", "value", "owner",
        (F.col("odd") != F.col("carry")).alias("inside"), (F.col("odd_after") != F.col("carry")).alias("open"),
        F.when(F.col("carry"), F.col("odd_start")).otherwise(F.col("even_start")).alias("start"),
    )
    plain = joined.where(~F.col("inside") & ~F.col("open")).select("file", "value", F.col("block").alias("_block"), F.col("line").alias("_line"))
    own = F.col("start") >= 0
    parts = joined.where(F.col("inside") | F.col("open")).select(
        "file", "block", "line", "value",
        F.when(own, F.col("block")).otherwise(F.col("owner.block")).alias("_block"), F.when(own, F.col("start")).otherwise(F.col("owner.line")).alias("_line"),
    )
    grouped = parts.groupBy("file", "_block", "_line").agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("_parts"))
    whole = grouped.select("file", F.array_join(F.col("_parts.value"), "\n").alias("value"), "_block", "_line")
    return plain.unionByName(whole).select(
        "file", F.regexp_replace("value", r"\r$", "").alias("record"), ((F.col("_block") == 0) & (F.col("_line") == 0)).alias("is_first")
    )


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """As ``files.read_ragged_csv`` with ``multi_line=True``, but split: the first record of
    each file is its header, empty lines are no records."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_record"]])
    records = read_records(spark, path).where(~F.col("is_first") & (F.col("record") != ""))
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record", "multiLine": "true"}
    parsed = records.select(F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("_r")).select("_r.*")
    return files.repaired(parsed, columns)
