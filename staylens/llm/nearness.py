"""Near duplicates: texts whose sets of five-word shingles have a Jaccard similarity
of 0.8 or more, and whatever such pairs chain together.

MinHash bands find candidates: 20 bands of five minima, of which a pair of
similarity 0.8 shares none in 0.04 % of cases, one of 0.85 in less than 0.002 %.
Inside a band's bucket all pairs are held against each other by a 256-bit SimHash,
with a bound four standard deviations beyond what pairs of similarity 0.8 differ by;
texts of few shingles, whose SimHash says little, are candidates of all. A spanning
forest of these links leaves the bucket: n - 1 edges of two numbers. A bucket of over
``BUCKET`` nodes is dealt into chunks, and each pair of chunks is a task's work.

The forests only say which texts can be linked at all: the components of candidates.
Each text of a component then travels once to where its component is decided, and
there pairs are checked by their exact similarity, nearest first, except those that are
linked already by others. A pair that fails takes nothing from the next one, so no
link between candidates is lost. A component of over ``CHUNK`` shingles is dealt into
chunks, and each pair of chunks is decided apart. Equal sets are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.components import components
from staylens.llm.shared import SEED, keyed_texts, maybe_among, pieces, stored

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
#: 64-bit words of a fingerprint, and bits in which candidates may differ (39 on average at similarity 0.8, deviation 5.7).
LANES, SPREAD = 4, 62
#: Sets of fewer shingles are not told apart by their bits.
FEW = 40
#: Nodes that one task compares in full.
BUCKET = 4096
#: Shingles that a chunk of a component holds, about.
CHUNK = 1 << 21

_RNG = np.random.default_rng(SEED)
FACTORS = _RNG.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
OFFSETS = _RNG.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)
SALTS = _RNG.integers(0, 1 << 64, LANES, dtype=np.uint64)


def shingles(text: str) -> np.ndarray:
    """Sorted hashes of the different runs of five words; shorter texts are one run, empty ones none."""
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return np.zeros(0, dtype="<u8")
    n, line = min(WORDS, len(parts)), b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.unique(np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[: len(parts) - n + 1].tolist(), ends[n - 1 :].tolist())], dtype="<u8"))


def mixed(h: np.ndarray, salt: np.uint64) -> np.ndarray:
    h = (h ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bits(found: np.ndarray) -> bytes:
    """A bit is 1 if it is set in over half of the hashes."""
    votes = np.zeros((LANES, 64), dtype=np.int64)
    for at in range(0, len(found), 1 << 14):
        for lane, salt in enumerate(SALTS):
            votes[lane] += np.unpackbits(mixed(found[at : at + (1 << 14)], salt).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > len(found), axis=1, bitorder="little").tobytes()


def bands(found: np.ndarray) -> list[int]:
    """One signed 64-bit name per band."""
    if not len(found):
        return []
    least = np.full(BANDS * ROWS, (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(found), 1 << 12):
        least = np.minimum(least, (found[at : at + (1 << 12), None] * FACTORS + OFFSETS).min(axis=0))
    names = [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(names, dtype=np.uint64).view(np.int64).tolist()


def forest(prints: np.ndarray, few: np.ndarray) -> Iterator[tuple[int, int]]:
    """Nearest-first spanning forest of the links within ``SPREAD``, one row of
    distances at a time; prints are (n, LANES), ``few`` marks small sets."""
    n = len(prints)
    nearest, by, rest = np.full(n, 1 << 20), np.full(n, -1), np.ones(n, dtype=bool)
    for _ in range(n):
        at = int(np.argmin(np.where(rest, nearest, 1 << 21)))
        if by[at] >= 0:
            yield at, int(by[at])
        rest[at] = False
        far = np.bitwise_count(prints ^ prints[at]).sum(axis=1, dtype=np.int64)
        closer = rest & ((far <= SPREAD) | few | few[at]) & (far < nearest)
        nearest[closer], by[closer] = far[closer], at


def _links(buckets: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` from rows of ``found``, the (id, bits, few) of a bucket."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for found in batch.column(0).to_pylist():
                found = sorted((x["id"], x["bits"], x["few"]) for x in found)
                prints = np.frombuffer(b"".join(x[1] for x in found), np.uint64).reshape(-1, LANES)
                out += [tuple(sorted((found[i][0], found[j][0]))) for i, j in forest(prints, np.array([x[2] for x in found]))]
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return buckets.select("found").mapInArrow(compared, "a bigint, b bigint")


def candidates(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` between numbers, from the different ``(id, bits, n, slots)``."""
    keyed = distinct.select(F.explode("slots").alias("slot"), "id")
    counts = stored(keyed.groupBy("slot").agg(F.count("*").alias("many")).where("many > 1"))
    shared = stored(keyed.join(counts, "slot"))
    shared = stored(shared.join(distinct.select("id", "bits", (F.col("n") < FEW).alias("few")), "id"))
    found = F.collect_list(F.struct("id", "bits", "few")).alias("found")
    edges = _links(shared.where(F.col("many") <= bucket).groupBy("slot").agg(found))
    chunks = F.ceil(F.col("many") * 2 / F.lit(bucket)).cast("int")
    dealt = shared.where(F.col("many") > bucket).withColumn("i", F.pmod(F.xxhash64("id"), chunks).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), chunks - 1)))
    large = _links(dealt.groupBy("slot", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high")).agg(found))
    return stored(edges.union(large).distinct())


def similar(x: np.ndarray, y: np.ndarray, at_least: float = SIMILARITY) -> bool:
    """Exact Jaccard similarity of two sorted sets; two empty ones are equal."""
    if len(x) > len(y):
        x, y = y, x
    if len(x) < at_least * len(y):
        return False
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0
    return common >= at_least * (len(x) + len(y) - common)


def linked(sets: list[np.ndarray], side: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the exact links between rows of different sides, or between
    all if there is one side only."""
    prints = np.array([np.frombuffer(bits(s), np.uint64) for s in sets]).reshape(-1, LANES)
    sizes = np.array([len(s) for s in sets])
    few, group, across = sizes < FEW, np.arange(len(sets)), len(set(side.tolist())) > 1
    for i in range(len(sets) - 1):
        far = np.bitwise_count(prints[i + 1 :] ^ prints[i]).sum(axis=1, dtype=np.int64)
        may = ((far <= SPREAD) | few[i + 1 :] | few[i]) & (group[i + 1 :] != group[i])
        may &= np.minimum(sizes[i + 1 :], sizes[i]) >= SIMILARITY * np.maximum(sizes[i + 1 :], sizes[i])
        if across:
            may &= side[i + 1 :] != side[i]
        at = np.flatnonzero(may)
        for j in (at[np.argsort(far[at], kind="stable")] + i + 1).tolist():
            if group[j] != group[i] and similar(sets[i], sets[j]):
                group[group == group[j]] = group[i]
                yield i, j


def verified(members: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Edges ``(a, b)`` of similar sets inside each candidate component; ``members``:
    (id, root, n, text), one row per node."""
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(chunk)).cast("int").alias("chunks"))
    dealt = members.join(stored(sizes), "root").withColumn("i", F.pmod(F.xxhash64("id"), F.greatest("chunks", F.lit(1))).cast("int"))
    dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.greatest("chunks", F.lit(1)) - 1)))
    pairs = dealt.select("root", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"), "i", "id", "text")
    pairs = pairs.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "id")

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, side, sets = None, [], [], []

        def sent() -> pa.RecordBatch:
            found = [(ids[i], ids[j]) for i, j in linked(sets, np.array(side))]
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for root, low, high, i, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, low, high) != now:
                    if len(ids) > 1:
                        yield sent()
                    now, ids, side, sets = (root, low, high), [], [], []
                ids.append(node)
                side.append(i)
                sets.append(shingles(text))
        if len(ids) > 1:
            yield sent()

    return stored(pairs.mapInArrow(decided, "a bigint, b bigint"))


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", bucket: int = BUCKET, chunk: int = CHUNK) -> DataFrame:
    """Per row: ``doc_id``, ``digest`` (xxhash64 of the text) and ``class_name``, one per component."""
    name = F.coalesce(F.concat(F.lit("1"), F.col("doc_id").cast("string")), F.lit("0")).alias("name")
    rows = keyed_texts(df, key, text).select("doc_id", "text", F.xxhash64("text").alias("digest"), name)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = [(xxhash.xxh3_128_digest(s.tobytes()), bits(s), bands(s), len(s)) for s in map(shingles, batch.column(1).to_pylist())]
            node, prints, slots, n = list(zip(*out)) or [()] * 4
            made = [pa.array(node, pa.binary()), pa.array(prints, pa.binary()), pa.array(slots, pa.list_(pa.int64())), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *made], ["doc_id", "digest", "name", "node", "bits", "slots", "n"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    seen = stored(rows.mapInArrow(hashed, f"doc_id {kind}, digest bigint, name string, node binary, bits binary, slots array<bigint>, n bigint"))
    one = [F.first(c).alias(c) for c in ("bits", "slots", "n")]
    distinct = stored(seen.groupBy("node").agg(*one, F.min(F.struct("name", "digest")).alias("row")).withColumn("id", F.monotonically_increasing_id()))
    candidate = components(candidates(distinct, bucket)).select(F.col("node").alias("id"), "root")
    held = stored(distinct.select("id", "n", "row.name", "row.digest").join(candidate, "id"))
    # Of all texts only those of candidates are moved, each once, and not the copies of one.
    asked = maybe_among(rows, held, ["name", "digest"], "asked").where("asked").select("name", "digest", "text").dropDuplicates(["name", "digest"])
    members = stored(held.join(asked, ["name", "digest"]).select("id", "root", "n", "text"))
    roots = stored(components(verified(members, chunk)).select(F.col("node").alias("id"), "root"))
    named = stored(distinct.select("node", "id").join(roots, "id", "left").select("node", F.coalesce("root", "id").cast("string").cast("binary").alias("class_name")))
    return seen.select("doc_id", "digest", "node").join(named, "node").select("doc_id", "digest", "class_name")
