"""Benchmark decontamination by SimHash of item-sized windows.

A window has as many words as the benchmark item it is held against, less where the
text begins or ends inside it. A window can only be similar to an item if the two
share a shingle, so windows are placed where a text holds a shingle of an item: at
the start that lines the two up, and where a run of such shingles begins or ends at the
window's own border (moved on to there, a window is no less similar). A window is bound to the items whose rarest shingles it
holds: of these, as many are taken as weigh more than a window may miss. Each window
gets a SimHash. It is cut into radius + 1 blocks; a fingerprint within the radius of an
item's agrees with it in one block at least, so joining on (item, block, bits of the
block) finds all of them. What is found is checked by weighted-shingle similarity,
exactly. All of it is built-in functions of Spark; no Python runs in tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.shared import keyed_texts, stored, text_of
from staylens.llm.sketches import shingle_hashes

WORDS = 5
#: Bits. Windows of similarity 0.8 differ in 10 bits on average, with a deviation of 3.
RADIUS = 21
SIMILARITY = 0.8
#: Shingles of the benchmark up to which its table is sent to all tasks; beyond, shingles are shuffled
#: (16 bytes and the key each), and windows are cut from the texts that hold one.
BROADCAST_ROWS = 500_000


def normal_words(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def with_shingles(df: DataFrame, words: int) -> DataFrame:
    df = df.withColumn("_words", normal_words(F.col("text"))).withColumn("n_words", F.size("_words"))
    return df.withColumn("shingles", shingle_hashes(F.col("_words"), words)).drop("_words")


def simhash(shingles: Column) -> Column:
    """A bit is 1 if it is set in over half of the hashes."""
    def votes(bit: Column) -> Column:
        return F.aggregate(shingles, F.lit(0), lambda n, h: n + F.call_function("getbit", h, bit).cast("int"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(votes(b) * 2 > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda all_, b: all_.bitwiseOR(b))


def blocks(bits: Column, radius: int) -> Column:
    """``radius + 1`` structs of block number and the bits of that block."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(bits, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("bigint")).alias("value"))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ])


def benchmark_items(benchmark: DataFrame, words: int, item: str, text: str) -> DataFrame:
    """``(item_id, form, n_words, shingles)`` of the items that have words.

    ``form`` stands for the words: items of equal words share it, whatever their ids
    are, and are compared once. Equal rows count once.
    """
    rows = benchmark.select(F.col(item).alias("item_id"), text_of(text).alias("text")).distinct()
    return stored(with_shingles(rows, words).drop("text").where("n_words > 0").withColumn("form", F.xxhash64("n_words", "shingles")))


def weighted(items: DataFrame) -> tuple[DataFrame, Column]:
    """``(form, n_words, shingles, parts)``: ``parts`` are the different shingles with
    count and weight ln(1 + items / items that hold it). And the weight of a shingle of
    one item."""
    n = F.lit(float(max(1, items.count())))
    forms = items.groupBy("form", "n_words").agg(F.first("shingles").alias("shingles"), F.count("*").alias("n_items"))
    counts = forms.select("form", "n_items", F.explode("shingles").alias("h")).groupBy("form", "n_items", "h").agg(F.count("*").alias("c"))
    held = counts.groupBy("h").agg(F.sum("n_items").alias("held"))
    weights = counts.join(held, "h").groupBy("form").agg(F.collect_list(F.struct("h", "c", F.log1p(n / F.col("held")).alias("w"))).alias("parts"))
    return forms.drop("n_items").join(weights, "form"), F.log1p(n)


def rarest(parts: Column, at_least: float) -> Column:
    """Shingles of an item, the heaviest first, that weigh more together than a window of
    similarity ``at_least`` may miss. Each such window holds one of them."""
    weight = lambda p: p["w"] * p["c"]
    missed = (1 - at_least + 1e-9) * F.aggregate(parts, F.lit(0.0), lambda s, p: s + weight(p))
    heaviest = F.array_sort(F.transform(parts, lambda p: F.struct((-p["w"]).alias("order"), p["h"].alias("h"), weight(p).alias("all"))))
    nothing = F.struct(F.lit(0.0).alias("all"), F.array().cast("array<bigint>").alias("hs"))
    taken = F.aggregate(
        heaviest, nothing,
        lambda s, p: F.when(s["all"] > missed, s).otherwise(F.struct((s["all"] + p["all"]).alias("all"), F.concat(s["hs"], F.array(p["h"])).alias("hs"))),
    )
    return taken["hs"]


def similarity(window: Column, parts: Column, rare: Column) -> Column:
    """Weighted Jaccard similarity with counts; a shingle that the item lacks weighs as one of a single item."""
    held = lambda p: F.size(F.filter(window, lambda x: x == p["h"]))
    low = F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["w"] * F.least(p["c"], held(p)))
    high = F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["w"] * F.greatest(p["c"], held(p)))
    other = F.size(F.filter(window, lambda x: ~F.exists(parts, lambda p: p["h"] == x)))
    return low / (high + rare * other)


def windows_of(texts: DataFrame, items: DataFrame, words: int) -> DataFrame:
    """``(doc_id, digest, item_words, start_word, window)`` where a text holds a shingle
    of an item of at least ``words`` words."""
    wanted = items.select(F.col("n_words").alias("item_words"), F.posexplode("shingles").alias("item_at", "h"))
    wanted = wanted.select("item_words", "item_at", "h").distinct()
    held = wanted.select(F.col("item_words").alias("_words"), F.col("h").alias("_h")).distinct()
    # The outer form: for the other, Spark would infer a filter on the array and push it below the words, to compute all again.
    placed = texts.select("doc_id", "digest", "shingles", F.posexplode_outer("shingles").alias("at", "h"))
    placed = placed.withColumns({"before": F.when(F.col("at") > 0, F.get("shingles", F.col("at") - 1)), "after": F.get("shingles", F.col("at") + 1)})
    small = (items.agg(F.sum(F.size("shingles"))).first()[0] or 0) <= BROADCAST_ROWS
    if small:  # Nothing is shuffled before the joins, so a row may hold on to its text's shingles.
        wanted, held = F.broadcast(wanted), F.broadcast(held)
    else:
        placed = placed.drop("shingles")
    hits = placed.join(wanted, "h")
    for side in ("before", "after"):
        beside = held.select(F.col("_words").alias(f"_words_{side}"), F.col("_h").alias(f"_{side}"))
        hits = hits.join(beside, (F.col("item_words") == F.col(f"_words_{side}")) & (F.col(side) == F.col(f"_{side}")), "left")
    at = F.col("at")
    begins, ends = F.when(F.col("_before").isNull(), at), F.when(F.col("_after").isNull(), at - F.col("item_words") + words)
    starts = F.array_distinct(F.array_compact(F.array(at - F.col("item_at"), begins, ends)))
    if small:
        placed = hits.select("doc_id", "digest", "item_words", "shingles", F.explode(starts).alias("start_word"))
    else:
        places = hits.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "item_words", F.explode(starts).alias("start_word"))
        placed = texts.join(stored(places.distinct()), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    length = F.col("item_words") - (words - 1) + F.least(F.col("start_word"), F.lit(0))
    window = F.slice("shingles", F.greatest(F.col("start_word"), F.lit(0)) + 1, F.greatest(length, F.lit(1)))
    cut = placed.select("doc_id", "digest", "item_words", "start_word", window.alias("window"))
    return stored(cut.groupBy("doc_id", "digest", "item_words", "start_word").agg(F.first("window").alias("window")))


def short_leaks(texts: DataFrame, items: DataFrame, words: int) -> DataFrame:
    """Items of fewer than ``words`` words, found anywhere as a run of words."""
    lengths = [n for n in range(1, words) if items.where(F.col("n_words") == n).head(1)]
    if not lengths:
        return texts.select("doc_id", "digest", F.lit(0).cast("bigint").alias("form"), F.lit(0).alias("start_word"), F.lit(0).alias("n_words")).limit(0)
    split = texts.select("doc_id", "digest", normal_words(F.col("text")).alias("_words"))
    runs = [
        split.where(F.size("_words") >= n).select("doc_id", "digest", F.lit(n).alias("n_words"), F.posexplode(shingle_hashes(F.col("_words"), n)).alias("start_word", "h"))
        for n in lengths
    ]
    short = items.where(F.col("n_words") < words).select("form", "n_words", F.get("shingles", F.lit(0)).alias("h")).distinct()
    return reduce(DataFrame.unionByName, runs).join(short, ["n_words", "h"]).select("doc_id", "digest", "form", "start_word", "n_words").distinct()


def leaks(
    df: DataFrame,
    benchmark: DataFrame,
    words: int = WORDS,
    radius: int = RADIUS,
    at_least: float = SIMILARITY,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per window of a text that is similar to a benchmark item:
    ``doc_id``, ``digest`` (xxhash64 of the text), ``item_id``, ``start_word``,
    ``n_words``, ``distance`` (bits), ``similarity``.

    Texts and items without words, NULL or empty, leak nothing and are no leak.
    Items of fewer words than a shingle are one run of words, found wherever it
    stands. Repeated rows give the same windows once. NULL keys stay NULL.
    """
    items = benchmark_items(benchmark, words, item, item_text)
    plain = keyed_texts(df, key, text).withColumn("digest", F.xxhash64("text"))
    long_ = items.where(F.col("n_words") >= words)
    parts, rare = weighted(long_)
    parts = stored(parts.withColumn("item_bits", simhash(F.col("shingles"))).withColumn("rarest", rarest(F.col("parts"), at_least)).drop("shingles"))
    signed = windows_of(with_shingles(plain, words).drop("text", "n_words"), long_, words).withColumn("bits", simhash(F.col("window")))
    signed = stored(signed.withColumn("_id", F.xxhash64("doc_id", "digest", "item_words", "start_word")))

    # A window meets the items alone whose rarest shingles it holds.
    anchors = parts.select(F.col("n_words").alias("item_words"), "form", F.explode("rarest").alias("h"))
    bound = signed.select("_id", "item_words", "bits", F.explode(F.array_distinct("window")).alias("h")).join(anchors, ["item_words", "h"]).select("_id", "form", "bits").distinct()
    slots = bound.select("_id", "form", "bits", F.explode(blocks(F.col("bits"), radius)).alias("b")).select("_id", "form", "bits", "b.*")
    item_slots = parts.select("form", "item_bits", F.explode(blocks(F.col("item_bits"), radius)).alias("b")).select("form", "item_bits", "b.*")
    distance = F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits")))
    near = slots.join(item_slots, ["form", "block", "value"]).where(distance <= radius).select("_id", "form", distance.alias("distance")).distinct()

    checked = near.join(signed, "_id").join(parts, "form").withColumn("similarity", similarity(F.col("window"), F.col("parts"), rare))
    found = checked.where(F.col("similarity") >= at_least).select("doc_id", "digest", "form", F.greatest("start_word", F.lit(0)).alias("start_word"), "n_words", "distance", "similarity")
    short = short_leaks(plain, items, words).withColumns({"distance": F.lit(0), "similarity": F.lit(1.0)})
    ids = items.select("form", "item_id").distinct()
    return found.unionByName(short).join(ids, "form").select("doc_id", "digest", "item_id", "start_word", "n_words", "distance", "similarity")


def without_leaks(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` whose text holds no benchmark item, unchanged."""
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    found = stored(leaks(df, benchmark, **options).select(F.col("doc_id").alias("_leak_id"), F.col("digest").alias("_leak_digest")).distinct())
    same = df[key].eqNullSafe(found["_leak_id"]) & (F.xxhash64(F.coalesce(df[text].cast("string"), F.lit(""))) == found["_leak_digest"])
    return df.join(found, same, "left_anti")
