"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 42
#: Bytes of an Arrow batch that goes to Python. Spark's own limit is 10 000 rows, which for texts are tens of MB,
#: and each task holds several copies: rows, buffers, what the worker reads.
BATCH = "2m"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is used if all tasks run in the
    driver's own process; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="staylens-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and
    lost executors cost no recomputation. The folder goes when the
    application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=list(partition_by) or None)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few MB, unless the session names a limit itself."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, BATCH)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """A text column as a string; NULL is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def keyed_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text (NULL: empty), so that other columns, whatever
    they are called, neither travel nor clash."""
    return df.select(F.col(key).alias("doc_id"), text_of(text).alias("text"))


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies. ``STAYLENS_TOKENIZERS`` may name another folder."""
    if folder := os.environ.get("STAYLENS_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


#: Bits of the filter of ``maybe_among``: 4 MB, whatever it holds.
FILTER_BITS = 1 << 25


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def maybe_among(df: DataFrame, keys: DataFrame, columns: list[str], out: str) -> DataFrame:
    """``df`` with ``out``: false where the values of ``columns`` are surely in no row of
    ``keys``, so that only the other rows need be moved to a join with ``keys``.

    A bit filter of fixed size is broadcast. The more keys there are, the more rows pass
    it; with very many all do, and the join then moves everything.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    bucket, bits, at = (free_name(df, n) for n in ("_bucket", "_bits", "_at"))
    marked = keys.select(place.alias(at)).groupBy(F.bitmap_bucket_number(at).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias(bits))
    here = df.withColumn(at, place).join(F.broadcast(marked), F.bitmap_bucket_number(at) == F.col(bucket), "left")
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return here.withColumn(out, F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))).drop(bucket, bits, at)


def in_blocks(texts: list[str], rows: int = 256, chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold a bounded number of characters, one row at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= rows or size + len(t) > chars):
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)
