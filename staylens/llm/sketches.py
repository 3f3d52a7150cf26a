"""Document fingerprints: bottom-k sketches of five-word shingles.

A sketch is the sorted array of the k smallest different 64-bit shingle hashes.
Sketches of parts merge into the sketch of the whole. All of it is built-in
functions of Spark; no Python runs in tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.shared import keyed_texts, stored

K = 128
WORDS = 5
#: Ranges of keys whose bounds the driver holds, and rows of a bucket inside them.
RANGES = 256
BUCKET = 1024


def word_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(text, r"\s+"), ""), lambda w: F.xxhash64(w))


def shingle_hashes(words: Column, n: int = WORDS) -> Column:
    """Hashes of all runs of ``n`` words; shorter texts are one run, empty texts none.

    ``words`` must be a column of its own, not an expression, since it is read at
    every position.
    """
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(n)]))
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(words) >= n, runs).otherwise(whole)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: Column, name: str, k: int = K, n: int = WORDS) -> DataFrame:
    """``df`` with the sketch of a text expression as column ``name``."""
    words = f"_{name}_words"
    return df.withColumn(words, word_hashes(text)).withColumn(name, bottom(shingle_hashes(F.col(words), n), k)).drop(words)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; exact where both hold all of their hashes.
    Two empty sketches are alike (1), an empty and another are not (0)."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(common / F.greatest(F.size(union), F.lit(1)))


def shingle_count(sketch: Column, k: int = K) -> Column:
    """Estimated number of different shingles: exact below k, else (k - 1) over
    the share of the hash range that the k smallest hashes span."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(float(2**63))) / F.lit(float(2**64))
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: what both have in common,
    resemblance times the size of the union, over the size of a."""
    union = shingle_count(F.slice(F.sort_array(F.array_union(a, b)), 1, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * union / shingle_count(a, k)))


def merged(df: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """The sketch of each group's union, for groups of any size.

    Hashes of a group are first cut to the k smallest in each of 64 parts, then
    over the parts, so no task gets more of a group than a part's hashes.
    """
    hashes = df.select(*keys, F.explode(sketch).alias("_h")).distinct()
    for by in ([*keys, F.pmod("_h", F.lit(64))], keys):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("_h"))
        hashes = hashes.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
    return hashes.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def as_text(sketch: Column) -> Column:
    """16 lower-case hex digits per hash, in order."""
    return F.lower(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _bucketed(rows: DataFrame, ranges: int, bucket: int) -> DataFrame:
    """``rows`` with ``_range`` and ``_part``: buckets that follow each other as the
    keys do, of about ``bucket`` rows if keys are spread evenly inside a range.

    Bounds are quantiles of the key, ``ranges`` of them, the only thing that the
    driver sees.
    """
    at = [i / ranges for i in range(ranges + 1)]
    seen = rows.agg(F.count("*"), F.percentile_approx("doc_id", at, 10_000)).first()
    bounds = sorted(set(seen[1] or [0]))
    parts = max(1, seen[0] // (len(bounds) * bucket))
    key = F.coalesce(F.col("doc_id"), F.lit(bounds[0]))
    range_ = F.greatest(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= key)) - 1, F.lit(0))
    low = F.get(F.array(*[F.lit(float(b)) for b in bounds]), F.col("_range"))
    width = F.get(F.array(*[F.lit(float(max(1, b - a))) for a, b in zip(bounds, [*bounds[1:], bounds[-1] + 1])]), F.col("_range"))
    part = F.greatest(F.lit(0.0), F.least((key.cast("double") - low) / width, F.lit(1.0)) * parts)
    return rows.withColumn("_range", range_).withColumn("_part", part.cast("int"))


def with_next(rows: DataFrame, ranges: int = RANGES, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, text, next_text)``: the next row's text by ascending key (NULL
    keys first, equal keys by text); the last is followed by the first.

    Texts are shuffled once, into buckets of neighbouring keys. Only the last row
    of each bucket looks for the first one of the next bucket.
    """
    placed = _bucketed(rows, ranges, bucket)
    buckets = stored(placed.select("_range", "_part").distinct())
    ends = {r["_range"]: (r["a"], r["b"]) for r in buckets.groupBy("_range").agg(F.min("_part").alias("a"), F.max("_part").alias("b")).collect()}
    order = sorted(ends)
    jumps = [(r, ends[r][1], to, ends[to][0]) for r, to in zip(order, [*order[1:], *order[:1]])]
    following = buckets.withColumn("_next_part", F.lead("_part").over(Window.partitionBy("_range").orderBy("_part")))
    following = following.where("_next_part is not null").select("_range", "_part", F.col("_range").alias("_next_range"), "_next_part")
    following = following.union(rows.sparkSession.createDataFrame(jumps, "_range int, _part int, _next_range int, _next_part int"))

    order_by = Window.partitionBy("_range", "_part").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    led = placed.select("*", F.lead("text").over(order_by).alias("next_text"), F.row_number().over(order_by).alias("_at"))
    inside = led.where("next_text is not null").select("doc_id", "text", "next_text")
    firsts = led.where("_at = 1").select(F.col("_range").alias("_next_range"), F.col("_part").alias("_next_part"), F.col("text").alias("next_text"))
    last = led.where("next_text is null").drop("next_text", "_at").join(following, ["_range", "_part"])
    return inside.union(last.join(firsts, ["_next_range", "_next_part"]).select("doc_id", "text", "next_text"))


def fingerprints(df: DataFrame, k: int = K, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` and the estimates
    ``n_shingles`` and ``contained_edited`` (share of the shingles that the edited
    text keeps).

    The edited text has its last floor(n_chars / 2) code points replaced by as many
    first ones of the next text. NULL and empty texts have an empty fingerprint.
    Keys are integers; repeated rows follow each other.
    """
    rows = with_next(keyed_texts(df, key, text))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select(
        "doc_id", "text", "next_text", n.cast("bigint").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"),
    )
    for source, name in (("text", "own"), ("edited", "other"), ("next_text", "next")):
        rows = with_sketch(rows, F.col(source), name, k)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("other"), k).alias("near_edited"), resemblance(F.col("own"), F.col("next"), k).alias("near_next"),
        shingle_count(F.col("own"), k).alias("n_shingles"), containment(F.col("own"), F.col("other"), k).alias("contained_edited"),
    )
