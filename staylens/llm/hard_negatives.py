"""Hard-negative mining by Kronecker-packed products.

Components become integers. A block of candidates is packed component by component:
each candidate's component, biased so that it isn't negative, fills a field of one
wide integer, so a single multiplication by an anchor's component (biased too) serves
all candidates of the block. Summed over the components, each field holds one inner
product with biased vectors, which never reaches the next field; the bias is then
taken off, and what remains is the exact integer score.

Anchors lie in blocks of ``ANCHORS``, the other rows in up to ``CHUNKS`` chunks, and
each pair of both is a unit of work: rows are dealt by a hash of their place, so
neither a label nor a vector that a third of all rows share makes a unit larger.
Inside a unit the anchors come first and stay (a bounded number); candidates stream
past in blocks, and only the best of each anchor leave. Candidates are read once per
block of anchors, which costs far less than the products of such a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.shared import stored

#: Components are multiplied by this and rounded down.
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative scores between these hundredths of the positive's score.
LEAST, MOST = 30, 90
#: Anchors that a task holds, candidates packed into one integer per component.
ANCHORS, PACKED = 8192, 1024
#: Chunks at most, and the rows that a chunk has at least where there are fewer.
CHUNKS, CHUNK_ROWS = 64, 2048


class Packed:
    """Candidates in wide integers, one per component: ``x`` is (candidates, components)."""

    def __init__(self, x: np.ndarray, bias: int) -> None:
        self.rows, width = x.shape
        self.bias = bias
        # The largest field: a sum of products of two biased components.
        self.bytes = 4 if width * (2 * bias) ** 2 < 1 << 32 else 8
        fields = (x.T + bias).astype(f"<u{self.bytes}")
        self.wide = [int.from_bytes(f.tobytes(), "little") for f in fields]
        self.taken = bias * x.sum(axis=1) + width * bias * bias

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The exact inner product of every candidate with ``anchor``."""
        total = sum(map(mul, self.wide, (anchor + self.bias).tolist()))
        fields = np.frombuffer(total.to_bytes(self.rows * self.bytes, "little"), f"<u{self.bytes}")
        return fields.astype(np.int64) - self.taken - self.bias * int(anchor.sum())


def integers(vector: Column) -> Column:
    """Components as whole numbers; NULL if any is NULL, NaN or infinite."""
    doubles = vector.cast("array<double>")
    whole = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(whole, F.transform(doubles, lambda x: F.floor(x * SCALE).cast("bigint")))


def prepared(df: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """``(id, label, x, row)`` of the rows that take part; ``row`` numbers rows, so that equal keys stay apart."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), integers(F.col(vector)).alias("x"))
    return stored(rows.where(F.col("label").isNotNull() & F.col("x").isNotNull()).withColumn("row", F.monotonically_increasing_id()))


def _units(anchors: DataFrame, rows: DataFrame, blocks: int, chunks: int) -> DataFrame:
    """Anchors and candidates of a unit beside each other, anchors first."""
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    chunk = F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")
    count = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    left = anchors.select(block.alias("block"), F.explode(count(chunks)).alias("chunk"), F.lit(0).alias("kind"), "id", "label", "x", "row", "positives")
    right = rows.select(F.explode(count(blocks)).alias("block"), chunk.alias("chunk"), F.lit(1).alias("kind"), "id", "label", "x", "row", F.lit(None).cast("array<bigint>").alias("positives"))
    return left.unionByName(right).repartition("block", "chunk").sortWithinPartitions("block", "chunk", "kind", "id", "row")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, padded with zeros to ``width``."""
    offsets = np.asarray(column.offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class _Best:
    """What the anchors of one unit have found so far; a subclass says which candidates count."""

    def __init__(self) -> None:
        self.anchors: list[tuple] = []
        self.found: dict[tuple, tuple[np.ndarray, ...]] = {}

    def keep(self, slot: tuple, score: np.ndarray, ids: np.ndarray, nulls: np.ndarray, most: int) -> None:
        """Merge candidates into a slot: higher scores first, then smaller ids, NULL last."""
        if old := self.found.get(slot):
            score, ids, nulls = (np.concatenate(x) for x in zip(old, (score, ids, nulls)))
        at = np.lexsort((ids, nulls, -score))[:most]
        self.found[slot] = score[at], ids[at], nulls[at]


class _Positives(_Best):
    def __init__(self, most: int) -> None:
        super().__init__()
        self.most = most

    def see(self, x, ids, nulls, labels, row_numbers, bias) -> None:
        own: dict[int, list[int]] = {}
        for i, anchor in enumerate(self.anchors):
            own.setdefault(anchor[1], []).append(i)
        for label in np.intersect1d(np.unique(labels), list(own)).tolist():
            at = np.flatnonzero(labels == label)
            packed = Packed(x[at], bias)
            for i in own[label]:
                row, _, vector, _ = self.anchors[i]
                score, other = packed.scores(vector), row_numbers[at] != row
                self.keep((i, 0), score[other], ids[at][other], nulls[at][other], self.most)

    def out(self) -> Iterator[tuple]:
        for (i, _), (score, ids, nulls) in self.found.items():
            for s, k, null in zip(score.tolist(), ids.tolist(), nulls.tolist()):
                yield self.anchors[i][0], None, None, None if null else k, s


class _Negatives(_Best):
    def __init__(self, most: int, low: int, high: int) -> None:
        super().__init__()
        self.most, self.low, self.high = most, low, high

    def see(self, x, ids, nulls, labels, row_numbers, bias) -> None:
        packed = Packed(x, bias)
        for i, (_, label, vector, positives) in enumerate(self.anchors):
            score = packed.scores(vector)
            # Candidates come by id, so a stable order by score breaks ties by the smaller one.
            order = np.flatnonzero(labels != label)
            order = order[np.argsort(-score[order], kind="stable")]
            ranked = 100 * score[order]
            for p in set(positives):
                first = np.searchsorted(-ranked, -self.high * p, side="left")
                last = np.searchsorted(-ranked, -self.low * p, side="right")
                at = order[first : min(last, first + self.most)]
                if len(at):
                    self.keep((i, p), score[at], ids[at], nulls[at], self.most)

    def out(self) -> Iterator[tuple]:
        for (i, p), (score, ids, nulls) in self.found.items():
            for s, k, null in zip(score.tolist(), ids.tolist(), nulls.tolist()):
                yield self.anchors[i][0], p, None, None if null else k, s


_OUT = "anchor_row bigint, positive_score bigint, chunk int, id bigint, score bigint"


def _search(units: DataFrame, make, width: int, bias: int) -> DataFrame:
    """Rows ``(anchor_row, positive_score, chunk, id, score)`` that each unit found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, best = None, make()

        def result(found: _Best) -> Iterator[pa.RecordBatch]:
            rows = list(found.out())
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor_row", "positive_score", "chunk", "id", "score"])

        for batch in batches:
            names = batch.schema.names
            col = {n: batch.column(i) for i, n in enumerate(names)}
            units_of = np.stack([col["block"].to_numpy(), col["chunk"].to_numpy(), col["kind"].to_numpy()])
            cuts = np.flatnonzero((np.diff(units_of, axis=1) != 0).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                here = (int(units_of[0, a]), int(units_of[1, a]))
                if here != unit:
                    yield from result(best)
                    unit, best = here, make()
                x = _matrix(col["x"].slice(a, b - a), width)
                labels = col["label"].slice(a, b - a).to_numpy(zero_copy_only=False)
                row_numbers = col["row"].slice(a, b - a).to_numpy(zero_copy_only=False)
                if units_of[2, a] == 0:
                    positives = col["positives"].slice(a, b - a).to_pylist()
                    best.anchors += zip(row_numbers.tolist(), labels.tolist(), x, positives)
                    continue
                nulls = np.asarray(col["id"].slice(a, b - a).is_null())
                ids = col["id"].slice(a, b - a).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                # By id, NULL last: the order within a block that breaks ties.
                order = np.lexsort((ids, nulls))
                for start in range(0, b - a, PACKED):
                    at = order[start : start + PACKED]
                    best.see(x[at], ids[at], nulls[at], labels[at], row_numbers[at], bias)
        yield from result(best)

    return units.mapInArrow(run, _OUT)


def _best(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    df: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LEAST, high: int = MOST,
    block: int = ANCHORS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    For each row that ``anchors`` (of column ``id``) takes and each of its first
    ``positives`` other rows of the same label, the first ``negatives`` rows of other
    labels whose score lies between ``low`` and ``high`` hundredths of the positive's.
    Scores are exact inner products of ``floor(256 * x)``; higher ones come first, ties
    by the smaller key, NULL keys last.

    Rows with a NULL label, a NULL vector or a NULL or non-finite component take no
    part. Rows of one key are different rows: each is an anchor, a positive or a
    negative of its own. Vectors of different lengths are padded with zeros. A positive
    of negative score has no negatives, as no score can lie between its bounds. Without
    rows or anchors the result is empty. Vectors so large that a hundred times an inner
    product might leave the range of a long are an error.
    """
    rows = prepared(df, key, vector, F.col(label) if isinstance(label, str) else label)
    largest = F.array_max(F.transform("x", lambda v: F.abs(v)))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(anchors).alias("a"), F.max(F.size("x")).alias("width"), F.max(largest).alias("most")).first()
    width, bias = max(1, sizes["width"] or 0), max(1, sizes["most"] or 0)
    if 100 * width * (2 * bias) ** 2 >= 1 << 63:
        raise ValueError("inner products of these vectors do not fit in a long")
    blocks = max(1, -(-sizes["a"] // block))
    chunks = max(1, min(CHUNKS, -(-sizes["n"] // chunk_rows)))
    chosen = rows.where(anchors)
    plain = chosen.withColumn("positives", F.lit(None).cast("array<bigint>"))
    found = _search(_units(plain, rows, blocks, chunks), lambda: _Positives(positives), width, bias)
    near = stored(_best(found, ["anchor_row"], positives).where("score >= 0").select("anchor_row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place")))
    held = near.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set("positive_score").alias("positives"))
    asked = stored(chosen.join(held, "row"))
    found = _search(_units(asked, rows, blocks, chunks), lambda: _Negatives(negatives, low, high), width, bias)
    hard = _best(found, ["anchor_row", "positive_score"], negatives).select("anchor_row", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.join(chosen.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")), "anchor_row")
    out = named.join(hard, ["anchor_row", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
