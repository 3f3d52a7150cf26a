"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of r + 1 bits. For each non-zero vector
v there is one table, whose mask keeps the positions with odd inner product with
v. Positions in which two fingerprints differ are at most r, so some v is
orthogonal to all of their vectors: in that table both fall into one bucket. With
r = 3 there are 15 tables of some 34 bits each, and no pair within the radius is
missed.

Equal fingerprints are one class from the start. A bucket of up to ``BUCKET``
different fingerprints is compared in full, inside one task, and only the edges of
its own components leave it. A larger bucket is covered again over the positions
that its mask left out, which each step about halves. Where few positions are left,
so that masks split no further, it is dealt into chunks, and each pair of chunks is
compared in a task of its own: all pairs are seen, none is emitted but the edges.

Three-word shingles at radius 3 miss most texts that share 80 % of their five-word
shingles, which differ in ten bits or more. ``representatives`` joins the classes of
fingerprints with those of ``nearness``, which checks that similarity exactly.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm import nearness
from staylens.llm.components import components
from staylens.llm.shared import free_name, maybe_among, SEED, keyed_texts, small_batches, stored

BITS = 64
RADIUS = 3
WORDS = 3
#: Different fingerprints that one task compares in full.
BUCKET = 4096
#: Free positions from which on a bucket that is too large is covered again.
FREE = 17


@dataclass(frozen=True)
class Rule:
    """What is fingerprinted and when two texts are linked. ``once``: each different
    shingle counts once; ``check_words``, ``check_radius``: words and bits of the
    second fingerprint that must agree too (0: none)."""

    words: int = WORDS
    radius: int = RADIUS
    once: bool = False
    check_words: int = 0
    check_radius: int = 64
    bucket: int = BUCKET


NARROW = Rule()


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(positions: list[int], radius: int) -> list[int]:
    """One mask per non-zero vector of ``radius + 1`` bits, over these positions."""
    vectors = list(range(1, 1 << radius + 1))
    random.Random(SEED).shuffle(vectors)  # in order, a few positions would get vectors that are all alike
    given = {p: vectors[i % len(vectors)] for i, p in enumerate(positions)}
    return [sum(1 << p for p, m in given.items() if (m & v).bit_count() % 2) for v in vectors]


def fingerprint(text: str, words: int = WORDS, once: bool = False) -> int:
    """64 bits; a bit is 1 if it is set in over half of the shingles' hashes."""
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return 0
    n = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    if n == 1:
        found = [digest(w, SEED) for w in (dict.fromkeys(parts) if once else parts)]
    else:
        line = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        found = [digest(line[a:b], SEED) for a, b in zip(starts[: len(parts) - n + 1].tolist(), ends[n - 1 :].tolist())]
        found = list(dict.fromkeys(found)) if once else found
    hashes = np.array(found, dtype="<u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, rule: Rule = NARROW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``digest`` (xxhash64 of the text), ``bits`` and ``check`` per row;
    NULL and empty texts have bits of zero."""
    rows = keyed_texts(df, key, text).withColumn("digest", F.xxhash64("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            bits = np.array([fingerprint(t, rule.words, rule.once) for t in texts], dtype=np.uint64)
            check = np.array([fingerprint(t, rule.check_words, True) for t in texts] if rule.check_words else np.zeros(len(texts)), dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(x.view(np.int64), pa.int64()) for x in (bits, check))], ["doc_id", "digest", "bits", "check"])

    return rows.mapInArrow(hashed, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest bigint, bits bigint, check bigint")


def node(bits: str, check: str) -> Column:
    """One name for a pair of fingerprints: 32 hex digits."""
    return F.lower(F.concat(F.lpad(F.hex(bits), 16, "0"), F.lpad(F.hex(check), 16, "0")))


def joined(bits: np.ndarray, check: np.ndarray, rule: Rule) -> Iterator[tuple[int, int]]:
    """For the members of a bucket, each with the first of its component inside the
    bucket (only where it is another one). Rows of the comparison are made in
    blocks, so that only one byte per pair is held."""
    n, block = len(bits), 256
    near = np.empty((n, n), dtype=bool)
    for at in range(0, n, block):
        rows = slice(at, at + block)
        near[rows] = np.bitwise_count(bits[rows, None] ^ bits[None, :]) <= rule.radius
        if rule.check_words:
            near[rows] &= np.bitwise_count(check[rows, None] ^ check[None, :]) <= rule.check_radius
    root = np.arange(n)
    while True:
        least = np.concatenate([np.where(near[at : at + block], root[None, :], n).min(axis=1) for at in range(0, n, block)])
        least = np.minimum(least, least[least])
        if (least == root).all():
            break
        root = least
    for i in np.flatnonzero(root != np.arange(n)):
        yield int(i), int(root[i])


def bucket_edges(buckets: DataFrame, rule: Rule) -> DataFrame:
    """Edges ``(a, b)`` from rows of ``found``, the (bits, check) of a bucket."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0)
            flat, ends = found.flatten(), np.asarray(found.value_lengths()).cumsum()
            bits = np.asarray(flat.field("bits")).view(np.uint64)
            check = np.asarray(flat.field("check")).view(np.uint64)
            edges: list[tuple[str, str]] = []
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
                name = lambda i, a=a: f"{int(bits[a + i]):016x}{int(check[a + i]):016x}"
                edges += [(name(i), name(j)) for i, j in joined(bits[a:b], check[a:b], rule)]
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.string()), pa.array([e[1] for e in edges], pa.string())], ["a", "b"])

    return buckets.select("found").mapInArrow(compared, "a string, b string")


def _level(rows: DataFrame, level_masks: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Edges of the buckets that are small enough, and the rows of the others.

    ``rows``: (mask, bits, check), ``level_masks``: (mask, keep), a few thousand rows
    at most, made from parameters alone.
    """
    keyed = rows.join(F.broadcast(level_masks), "mask").select(F.col("keep").alias("mask"), F.col("bits").bitwiseAND(F.col("keep")).alias("slot"), "bits", "check")
    counts = stored(keyed.groupBy("mask", "slot").agg(F.count("*").alias("n")).where("n > 1"))
    shared = stored(keyed.join(counts, ["mask", "slot"]))
    small = shared.where(F.col("n") <= rule.bucket).groupBy("mask", "slot").agg(F.collect_list(F.struct("bits", "check")).alias("found"))
    return stored(bucket_edges(small, rule).distinct()), shared.where(F.col("n") > rule.bucket)


def _chunk_edges(rows: DataFrame, rule: Rule) -> DataFrame:
    """Edges inside buckets that masks split no further, from each pair of chunks."""
    chunks = F.ceil(F.col("n") * 2 / F.lit(rule.bucket)).cast("int")
    dealt = rows.withColumn("i", F.pmod(F.xxhash64("bits", "check"), chunks).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), chunks - 1)))
    pairs = dealt.groupBy("mask", "slot", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"))
    return stored(bucket_edges(pairs.agg(F.collect_list(F.struct("bits", "check")).alias("found")), rule).distinct())


def near_edges(distinct: DataFrame, rule: Rule = NARROW) -> DataFrame:
    """Edges ``(a, b)`` between ``node`` names whose components are those of all
    linked pairs of the different ``(bits, check)``."""
    spark = distinct.sparkSession
    edges = spark.createDataFrame([], "a string, b string")
    free = lambda m: [p for p in range(BITS) if not m >> p & 1]
    rows, at = distinct.select(F.lit(0).cast("bigint").alias("mask"), "bits", "check"), [0]
    while at:
        pairs = [(signed(m), signed(m | more)) for m in at for more in masks(free(m), rule.radius)]
        found, large = _level(rows, spark.createDataFrame(pairs, "mask bigint, keep bigint").distinct(), rule)
        edges = edges.union(found)
        full = [r[0] & (1 << BITS) - 1 for r in large.select("mask").distinct().collect()]  # masks in use, made from parameters
        at = [m for m in full if len(free(m)) >= FREE]
        if len(at) < len(full):
            last = [signed(m) for m in full if len(free(m)) < FREE]
            edges = edges.union(_chunk_edges(large.where(F.col("mask").isin(last)), rule))
        rows = large.where(F.col("mask").isin([signed(m) for m in at])).select("mask", "bits", "check")
    return edges.distinct()


def classes(df: DataFrame, rule: Rule = NARROW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``digest``, ``bits``, ``class_name`` (one per component)
    and ``component_id`` (its smallest ``doc_id``).

    NULL and empty texts have fingerprint zero and are linked by it like any
    other. Repeated rows are linked; a NULL key stays NULL and is never the
    smallest, unless all of a component are NULL.
    """
    rows = stored(fingerprints(df, rule, key, text))
    distinct = stored(rows.groupBy("bits", "check").agg(F.min("doc_id").alias("least")))
    roots = stored(components(near_edges(distinct, rule)))
    classed = distinct.withColumn("node", node("bits", "check")).join(roots, "node", "left")
    classed = stored(classed.select("bits", "check", "least", F.coalesce("root", "node").alias("class_name")))
    named = stored(classed.groupBy("class_name").agg(F.min("least").alias("component_id")))
    members = stored(classed.select("bits", "check", "class_name").join(named, "class_name"))
    return rows.join(members, ["bits", "check"]).select("doc_id", "digest", "bits", "class_name", "component_id")


def joint_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``digest`` and ``class_name``: texts that the links of ``classes``
    and the exact similarity of ``nearness`` chain together.

    Classes of both kinds are the nodes, and a text is an edge between its two. Only
    classes that meet several of the other kind need components.
    """
    same = ["doc_id", "digest"]
    linked = classes(df, NARROW, key, text).select(*same, F.concat(F.lit("f"), "class_name").alias("linked")).distinct()
    alike = nearness.classes(df, key, text).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.concat(F.lit("s"), F.hex("class_name")).alias("alike"))
    both = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    rows = stored(alike.join(linked, both).select(*same, "linked", "alike"))
    pairs = stored(rows.select("linked", "alike").distinct())
    several = lambda c: pairs.groupBy(c).agg(F.count("*").alias("n")).where("n > 1").select(c)
    edges = stored(pairs.join(several("alike"), "alike", "left_semi").unionByName(pairs.join(several("linked"), "linked", "left_semi")).distinct())
    roots = stored(components(edges.select(F.col("linked").alias("a"), F.col("alike").alias("b"))))
    named = rows.join(roots.withColumnRenamed("node", "linked"), "linked", "left")
    return named.select(*same, F.coalesce("root", "linked").alias("class_name"))


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, unchanged, that stay: of each component the row of the
    smallest key (NULL keys last, equal keys by a hash of the text), and of repeated
    rows one. Rows that are alone in their component stay where they are."""
    small_batches(df.sparkSession)
    found = stored(joint_classes(df, key, text))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    stays = found.groupBy("class_name").agg(F.min_by(F.struct("doc_id", "digest"), order).alias("k"), F.count("*").alias("n")).where("n > 1")
    none, value, digest, maybe = (free_name(df, n) for n in ("_near_null", "_near_key", "_near_digest", "_near_maybe"))
    same = [none, value, digest]
    identity = lambda k, d: [k.isNull().alias(none), F.coalesce(k, F.lit(0).cast(df.schema[key].dataType)).alias(value), d.alias(digest)]
    member = found.join(stored(stays.select("class_name", "k")), "class_name")
    first = F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("digest") == F.col("k.digest"))
    decided = stored(member.select(*identity(F.col("doc_id"), F.col("digest")), first.alias("first")).groupBy(*same).agg(F.max("first").alias("first"), F.count("*").alias("n")))
    rows = df.select("*", *identity(df[key], F.xxhash64(F.coalesce(df[text].cast("string"), F.lit("")))))
    rows = maybe_among(rows, decided.where(~F.col("first") | (F.col("n") > 1)), same, maybe)
    alone = rows.where(~F.col(maybe)).select(*df.columns)
    gone = decided.where(~F.col("first")).select(*same)
    rest = rows.where(maybe).join(gone, same, "left_anti").dropDuplicates(same).select(*df.columns)
    return alone.unionByName(rest)


def near_duplicates(df: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 lower-case hex digits) and ``component_id`` of ``classes``."""
    found = classes(df, **options)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
