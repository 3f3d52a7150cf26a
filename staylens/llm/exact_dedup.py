"""Exact dedup over a cuckoo-filter index of live digests.

A text's identity is the SHA-256 of its normalised form, computed by Spark's own
functions; only digests and keys move, never texts. The index has buckets of four
slots. A slot holds a 16-bit mark of a digest, in the compact filter, and beside it,
in the bucketed content, the whole digest with its live rows. A digest lives in one of
two buckets, the second of which follows from the first and the mark, so that a slot
can be moved without its digest being hashed again. A mark that matches is only a
candidate: the whole digest of that very slot decides. Deletion clears a slot, which a
plain Bloom filter could not. Where a new digest finds no place after ``KICKS`` moves,
the index doubles and is filled again from its stored digests.

Each task runs an index over the rows that it reads, of at most ``LIVE`` live rows at a
time, and then sends one row per digest, so a digest that a third of all rows share is
summed before anything is shuffled. A sum per digest joins the parts.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.shared import stored, text_of

SLOTS, KICKS = 4, 200
#: Live rows that an index holds before its digests are sent on.
LIVE = 200_000
WHITE = r"[\x20\x09-\x0D]+"


class CuckooIndex:
    """Digests (of 16 bytes or more) with content, under insertion and deletion."""

    def __init__(self, buckets: int = 64) -> None:
        self.buckets = 1 << max(1, buckets - 1).bit_length()
        self.live = 0
        self._clear()

    def _clear(self) -> None:
        self.marks = array("H", bytes(2 * SLOTS * self.buckets))
        self.content: list[tuple[bytes, Any] | None] = [None] * (SLOTS * self.buckets)

    def _home(self, digest: bytes) -> tuple[int, int]:
        """Mark (never 0) and first bucket."""
        return int.from_bytes(digest[:2], "little") or 1, int.from_bytes(digest[2:10], "little") & (self.buckets - 1)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 >> 3 & (self.buckets - 1))

    def _slot(self, digest: bytes) -> int:
        """Where ``digest`` is, or -1. A matching mark counts only if its content is this digest."""
        mark, bucket = self._home(digest)
        for b in (bucket, self._other(bucket, mark)):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.content[slot][0] == digest:
                    return slot
        return -1

    def find(self, digest: bytes) -> Any:
        slot = self._slot(digest)
        return None if slot < 0 else self.content[slot][1]

    def insert(self, digest: bytes, content: Any) -> Any:
        """The content of ``digest``, which is ``content`` if it was not live."""
        slot = self._slot(digest)
        if slot >= 0:
            return self.content[slot][1]
        self.live += 1
        if homeless := self._place((digest, content)):
            self._resize(homeless)
        return content

    def _resize(self, homeless: tuple[bytes, Any]) -> None:
        """Twice the buckets, or more, filled again from the stored digests."""
        entries = [*self.items(), homeless]
        while True:
            self.buckets *= 2
            self._clear()
            if all(self._place(e) is None for e in entries):
                return

    def _place(self, entry: tuple[bytes, Any]) -> tuple[bytes, Any] | None:
        """Put an entry into a free slot, moving others; what finds no place comes back."""
        mark, bucket = self._home(entry[0])
        for b in (bucket, self._other(bucket, mark)):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.content[slot] = mark, entry
                    return None
        bucket = self._other(bucket, mark)
        for step in range(KICKS):
            slot = bucket * SLOTS + (step + mark) % SLOTS
            other = self.marks[slot], self.content[slot]
            self.marks[slot], self.content[slot] = mark, entry
            mark, entry = other
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.content[slot] = mark, entry
                    return None
        return entry

    def delete(self, digest: bytes) -> bool:
        slot = self._slot(digest)
        if slot < 0:
            return False
        self.marks[slot], self.content[slot] = 0, None
        self.live -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, Any]]:
        return (x for x in self.content if x)


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space."""
    return F.regexp_replace(text, WHITE, " ")


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, digest)`` per row; a NULL text is the empty one."""
    return df.select(F.col(key).alias("doc_id"), F.unhex(F.sha2(normalised(text_of(text)).cast("binary"), 256)).alias("digest"))


def _place_of(doc_id: Any, row: int) -> tuple:
    """Order of the rows of a digest: the smallest key, NULL last, then the row's number."""
    return doc_id is None, 0 if doc_id is None else doc_id, row


def _summed(rows: DataFrame, live: int) -> DataFrame:
    """``(digest, least, size)`` for each digest that a task's index holds; ``rows``: (digest, doc_id, row)."""
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()

        def sent() -> pa.RecordBatch:
            found = [(d, None if none else i, r, n) for d, ((none, i, r), n) in index.items()]
            kinds = (pa.binary(), doc_type, pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["digest", "doc_id", "row", "size"])

        for batch in batches:
            doc_type = batch.column(1).type
            for digest, doc_id, row in zip(*(c.to_pylist() for c in batch.columns)):
                place = _place_of(doc_id, row)
                content = index.insert(digest, [place, 0])
                content[1] += 1
                if place < content[0]:
                    content[0] = place
                if index.live >= live:
                    yield sent()
                    index = CuckooIndex()
        if index.live:
            yield sent()

    return rows.select("digest", "doc_id", "row").mapInArrow(run, f"digest binary, doc_id {kind.simpleString()}, row bigint, size bigint")


def groups(rows: DataFrame, live: int = LIVE) -> DataFrame:
    """``(digest, keep_id, keep_row, size)`` of ``rows(digest, doc_id, row)``."""
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    per = _summed(rows, live).groupBy("digest").agg(F.min(least).alias("k"), F.sum("size").alias("size"))
    return per.select("digest", F.col("k.doc_id").alias("keep_id"), F.col("k.row").alias("keep_row"), "size")


def decide(df: DataFrame, key: str = "doc_id", text: str = "text", live: int = LIVE) -> DataFrame:
    """Per row: ``doc_id``, ``keep_id`` (the key of the row that stays), ``group_size``,
    ``kept`` and ``text_sha256`` (of the normalised text).

    Texts are equal where they are after each run of ASCII white space became one
    space; leading and trailing runs become a space, too. NULL counts as empty. Of
    equal texts the row of the smallest key stays, NULL keys last, and of repeated
    rows exactly one. Texts of any length are hashed whole. An empty table gives an
    empty result.
    """
    rows = stored(digests(df, key, text).withColumn("row", F.monotonically_increasing_id()))
    many = stored(groups(rows, live).where("size > 1"))
    out = rows.join(many, "digest", "left")
    return out.select(
        "doc_id", F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"), F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def changed(live: DataFrame, inserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """The live index after a batch: ``(digest, doc_id, copies)``, which can be stored
    and given again as ``live`` with the next batch; no earlier text is read.

    ``inserts`` and ``deletes`` are rows of ``(digest, doc_id)`` as ``digests`` gives
    them. Deletions apply to what was live before, one copy each; what isn't live is
    not deleted. Insertions follow. Equal rows are summed before they are shuffled.
    """
    none = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    parts = [live.select("digest", "doc_id", F.col("copies").cast("bigint").alias("had"), none.alias("less"), none.alias("more"))]
    parts += [d.select("digest", "doc_id", none.alias("had"), a.alias("less"), b.alias("more")) for d, a, b in ((deletes, one, none), (inserts, none, one))]
    per = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("digest", "doc_id").agg(*[F.sum(c).alias(c) for c in ("had", "less", "more")])
    kind = per.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held = CuckooIndex(), 0

        def sent(doc_type: pa.DataType) -> pa.RecordBatch:
            found = [(d, i, n) for d, ids in index.items() for i, n in ids.items()]
            columns = list(zip(*found)) if found else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), doc_type, pa.int64()))], ["digest", "doc_id", "copies"])

        for batch in batches:
            doc_type = batch.column(1).type
            for digest, doc_id, had, less, more in zip(*(c.to_pylist() for c in batch.columns)):
                if had:
                    index.insert(digest, {})[doc_id] = had
                    held += 1
                if less and (ids := index.find(digest)) and doc_id in ids:
                    ids[doc_id] -= less
                    if ids[doc_id] <= 0:
                        del ids[doc_id]
                        held -= 1
                    if not ids:
                        index.delete(digest)
                if more:
                    ids = index.insert(digest, {})
                    held += doc_id not in ids
                    ids[doc_id] = ids.get(doc_id, 0) + more
                if held >= LIVE:
                    yield sent(doc_type)
                    index, held = CuckooIndex(), 0
        if held:
            yield sent(doc_type)

    return per.mapInArrow(run, f"digest binary, doc_id {kind}, copies bigint")


def live_groups(live: DataFrame) -> DataFrame:
    """``(digest, keep_id, group_size)`` of a live index; the smallest key stays, NULL last."""
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    return live.groupBy("digest").agg(F.min(least).alias("k"), F.sum("copies").alias("group_size")).select("digest", F.col("k.doc_id").alias("keep_id"), "group_size")
