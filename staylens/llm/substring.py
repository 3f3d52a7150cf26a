"""Substring dedup by sliding sentence spans.

From every sentence on, the shortest run of consecutive sentences is hashed that
has at least ``MIN_WORDS`` words and two sentences (or is one sentence of twice as
many words). Where a run ends depends on nothing before it, so a passage gives the
same runs wherever it stands. Of the places of a run, over all texts, the first
(by key, then by position) is kept; sentences that lie in a run at any other place
are removed.

A sentence of more than ``LONG`` words counts as several: it is cut after words that
their own hash chooses, and between two equal words, so that a passage that begins or
ends inside it is cut alike in every text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.shared import keyed_texts, maybe_among, stored

MIN_WORDS = 25
MIN_SENTENCES = 2
#: A sentence ends after its marks and the white space that follows, or with its line.
ENDS = re.compile(r"(?<![.!?])[.!?]++\s+|\n\s*")
#: Words of a sentence that is not cut, and of a piece of a longer one on average.
LONG, PIECE = 24, 5
WORD = re.compile(r"\S+\s*")


def pieces_of(sentence: str) -> Iterator[str]:
    """The sentence, cut at places that depend on the words beside them alone."""
    words = WORD.findall(sentence)
    if len(words) <= LONG:
        yield sentence
        return
    at, begin, last = len(sentence) - sum(map(len, words)), 0, ""
    for w in words:
        word = w.rstrip().lower()
        if word == last and at > begin:
            yield sentence[begin:at]
            begin = at
        at, last = at + len(w), word
        if zlib.crc32(word.encode("utf-8", "surrogatepass")) % PIECE == 0:
            yield sentence[begin:at]
            begin = at
    if at > begin:
        yield sentence[begin:at]


def sentences(text: str) -> list[str]:
    """All of the text, in sentences, or pieces of long ones, with the white space after them."""
    out, at = [], 0
    for m in ENDS.finditer(text):
        out += pieces_of(text[at : m.end()])
        at = m.end()
    if at < len(text):
        out += pieces_of(text[at:])
    return out


def spans(parts: list[str], min_words: int, min_sentences: int) -> Iterator[tuple[int, int, bytes]]:
    """First sentence, sentence after the last, and 128-bit hash of each run."""
    plain = [s.lower().split() for s in parts]
    size = [len(p) for p in plain]
    lines = [" ".join(p) for p in plain]
    end = words = 0
    for start in range(len(parts)):
        if start:
            words -= size[start - 1]
        if not size[start]:
            continue
        while end < len(parts) and (words < min_words or end - start < min_sentences and words < 2 * min_words):
            words += size[end]
            end += 1
        if words < min_words or end - start < min_sentences and words < 2 * min_words:
            return
        yield start, end, xxhash.xxh3_128_digest("\n".join(lines[start:end]))


def span_rows(df: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES) -> DataFrame:
    """``(high, low, doc_id, digest, first, upto)`` per run of each text."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), row, a, b)
                for row, text in enumerate(batch.column(1).to_pylist())
                for a, b, h in spans(sentences(text), min_words, min_sentences)
            ]
            columns = list(zip(*found)) or [()] * 5
            rows = pa.array(columns[2], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), batch.column(0).take(rows), batch.column(2).take(rows), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int32())],
                ["high", "low", "doc_id", "digest", "first", "upto"],
            )

    return df.select("doc_id", "text", "digest").mapInArrow(hashed, f"high bigint, low bigint, doc_id {kind}, digest bigint, first int, upto int")


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return keyed_texts(df, key, text).withColumn("digest", F.xxhash64("text"))


def repeated_spans(df: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs that stand anywhere before: ``doc_id``, ``digest`` (xxhash64 of the
    text), ``first`` and ``upto`` (sentences), ``kept_in`` (key of the first place).

    Hashes are summed up per run before they are shuffled in full, and what is
    repeated is written before it is joined, so that Spark may split a run that
    very many texts hold. A bit filter keeps most other runs out of that join.
    """
    rows = stored(span_rows(_texts(df, key, text), min_words, min_sentences))
    place = F.struct("doc_id", "digest", "first")
    seen = rows.groupBy("high", "low").agg(F.min(place).alias("origin"), F.count("*").alias("n"))
    repeated = stored(seen.where("n > 1").drop("n"))
    rows = maybe_among(rows, repeated, ["high", "low"], "_maybe").where("_maybe").drop("_maybe")
    later = rows.join(repeated, ["high", "low"]).where(~place.eqNullSafe(F.col("origin")))
    return stored(later.select("doc_id", "digest", "first", "upto", F.col("origin.doc_id").alias("kept_in")).distinct())


def without_repeats(df: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The texts that lose something: ``doc_id``, ``n_sentences``, ``n_removed``,
    ``removed`` (array of character ranges), ``kept_in`` (keys that hold the first
    place of what went) and ``text``, what is left.

    All other texts stay as they are and are not in the result. NULL and empty
    texts hold no run. Rows that agree in key and text are one and keep what one of
    them keeps; other rows are told apart even where their keys are equal or NULL.
    """
    runs = repeated_spans(df, min_words, min_sentences, key, text)
    gone = runs.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("first", "upto")).alias("runs"), F.array_sort(F.collect_set("kept_in")).alias("kept_in"))
    gone = stored(gone.withColumnRenamed("doc_id", "_id").withColumnRenamed("digest", "_digest"))
    texts = _texts(df, key, text)
    touched = texts.join(gone, texts["doc_id"].eqNullSafe(gone["_id"]) & (texts["digest"] == gone["_digest"])).select("doc_id", "text", "runs", "kept_in")
    kind = touched.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text_, runs_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts, at = sentences(text_), 0
                removed = {i for r in runs_ for i in range(r["first"], r["upto"])}
                ranges: list[dict[str, int]] = []
                for i, part in enumerate(parts):
                    if i in removed:
                        if ranges and ranges[-1]["upto"] == at:
                            ranges[-1]["upto"] = at + len(part)
                        else:
                            ranges.append({"first": at, "upto": at + len(part)})
                    at += len(part)
                out.append((len(parts), len(removed), ranges, "".join(p for i, p in enumerate(parts) if i not in removed)))
            columns = list(zip(*out)) or [()] * 4
            ranges_type = pa.list_(pa.struct([("first", pa.int64()), ("upto", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], ranges_type), batch.column(3), pa.array(columns[3], pa.string())],
                ["doc_id", "n_sentences", "n_removed", "removed", "kept_in", "text"],
            )

    return touched.mapInArrow(cut, f"doc_id {kind}, n_sentences bigint, n_removed bigint, removed array<struct<first:bigint,upto:bigint>>, kept_in array<{kind}>, text string")
