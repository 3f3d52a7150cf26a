"""Vector bin packing of token sequences.

Every example asks for three things at once: tokens, one segment, and
loss-bearing tokens; a sequence offers a fixed amount of each. An open sequence
takes the example whose demand has the largest dot product with what is left in
it, both as shares of the limits, among those that fit. So a sequence that runs
short of segments takes long examples, and one that runs short of loss tokens
takes prompts.

Examples may be cut (plain text) or kept whole (instruction data). Where they
may be cut, a sequence that nothing fits takes the first part of the example of
the largest dot product, and a sequence that ends short is split at powers of
two, where no padding is needed.

Each Spark partition packs its own rows, a bounded pool at a time; no row
moves, and what a pool leaves over goes into the next one.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.shared import in_blocks, keyed_texts, pieces, small_batches, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Runs whose ids one Python worker keeps: so many newer ones, and as many used before them; those of one block come on top.
CACHE = 100_000
#: Characters of the texts whose words are Python objects at once (one text at least).
BLOCK = 500_000
#: Characters of a word that is kept.
LONGEST = 100
#: Marks that may follow letters. The vocabulary cuts between the two, never inside either. The
#: apostrophe is left out: it may take letters along.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Marks at the end of a word, after a letter of Latin-1 or a digit. What is searched for is the mark, since there are fewer.
ENDING = re.compile("[{0}](?<=[0-9A-Za-zªµºÀ-ÖØ-öø-ÿ][{0}])[{0}]*(?= |\\Z)".format(re.escape(MARKS)))
#: Runs of letters or marks that the library is given as one line.
LINE = 256

PIECE_SCHEMA = pa.schema(
    [
        ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_tokens", pa.int64()), ("loss_tokens", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Limits:
    """What one sequence holds. ``pool``: examples among which a task chooses."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048
    pool: int = 256


@dataclass
class Example:
    """Ids as little-endian unsigned 32-bit bytes; ``loss`` has one byte per id
    (1: bears loss), None if all do. ``start``: ids of the example that were
    placed before."""

    key: object
    ids: bytes
    loss: np.ndarray | None
    start: int
    total: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def demand(self) -> int:
        return len(self) if self.loss is None else int(self.loss.sum())

    def split(self, n: int) -> tuple[Example, Example]:
        loss = (None, None) if self.loss is None else (self.loss[:n], self.loss[n:])
        return (
            Example(self.key, self.ids[: 4 * n], loss[0], self.start, self.total),
            Example(self.key, self.ids[4 * n :], loss[1], self.start + n, self.total),
        )


def reach(example: Example, tokens: int, loss: int) -> int:
    """The longest first part within both limits."""
    if example.loss is None:
        return min(tokens, loss)
    return min(tokens, int(np.searchsorted(np.cumsum(example.loss), loss, side="right")))


def powers(n: int) -> list[int]:
    return [1 << bit for bit in reversed(range(n.bit_length())) if n >> bit & 1]


def fill(pool: list[Example], limits: Limits, cut: bool, last: bool) -> Iterator[list[Example]]:
    """Sequences from the pool. Unless it is the last, what would make a short
    sequence stays in the pool, and so do a few examples to choose from."""
    size = np.array([len(e) for e in pool], dtype=np.float64)
    loss = np.array([e.demand() for e in pool], dtype=np.float64)
    here = np.ones(len(pool), dtype=bool)
    scale = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
    keep = 0 if last else min(len(pool) // 4, limits.pool // 8)
    while (n_here := int(here.sum())) > keep:
        if not last and size[here].sum() < limits.tokens:
            break
        left, bin_ = scale.copy(), []
        while left[0] > 0 and left[1] > 0 and n_here:
            weight = left / scale / scale
            score = np.where(here, weight[0] * size + weight[1] + weight[2] * loss, -1.0)
            best = int(np.where((size <= left[0]) & (loss <= left[2]), score, -1.0).argmax())
            if here[best] and size[best] <= left[0] and loss[best] <= left[2]:
                bin_.append(pool[best])
                left -= (size[best], 1, loss[best])
                here[best] = False
                n_here -= 1
                continue
            best = int(score.argmax())
            part = reach(pool[best], int(left[0]), int(left[2]))
            if part <= 0 or not cut:
                break
            first, rest = pool[best].split(part)
            bin_.append(first)
            left -= (part, 1, first.demand())
            pool[best], size[best], loss[best] = rest, len(rest), rest.demand()
        yield bin_
    pool[:] = [e for e, stays in zip(pool, here) if stays]


def at_powers(bin_: list[Example]) -> Iterator[list[Example]]:
    """The same pieces in sequences whose lengths are powers of two."""
    rest = list(bin_)
    for n in powers(sum(map(len, bin_))):
        out = []
        while n:
            first = rest.pop(0)
            if len(first) > n:
                first, tail = first.split(n)
                rest.insert(0, tail)
            out.append(first)
            n -= len(first)
        yield out


def sequences(examples: Iterator[Example], limits: Limits, cut: bool) -> Iterator[list[Example]]:
    pool: list[Example] = []

    def made(last: bool) -> Iterator[list[Example]]:
        for bin_ in fill(pool, limits, cut, last):
            short = sum(map(len, bin_)) < limits.tokens
            yield from at_powers(bin_) if cut and short else [bin_]

    for example in examples:
        if not len(example):
            continue
        if len(example) > limits.tokens or example.demand() > limits.loss:
            if not cut:  # it fits no sequence whole: a sequence of its own, over the limit, so that no row is lost
                yield [example]
                continue
            while (part := reach(example, limits.tokens, limits.loss)) < len(example):
                if part <= 0:
                    raise ValueError("a limit of no tokens can't be kept")
                first, example = example.split(part)
                yield from [[first]] if part == limits.tokens else at_powers([first])
        pool.append(example)
        if len(pool) >= limits.pool:
            yield from made(False)
    yield from made(True)


def piece_rows(bins: Iterator[list[Example]], key_type: pa.DataType, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    first_id = TaskContext.get().partitionId() << 40
    names = ["doc_id", *PIECE_SCHEMA.names]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = [key_type, *PIECE_SCHEMA.types]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    found: list[tuple] = []
    for number, bin_ in enumerate(bins):
        offset, whole = 0, sum(map(len, bin_))
        for e in bin_:
            found.append((e.key, e.start, len(e), zlib.crc32(e.ids), e.total, first_id + number, offset, whole, e.demand()))
            offset += len(e)
        if len(found) >= rows:
            yield batch(found)
            found = []
    if found:
        yield batch(found)


def little(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def latin(text: str) -> bool:
    """Whether all characters are of Latin-1, whose letters have one lower-case form each."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordIds:
    """Ids of whole texts. The vocabulary drops white space and no token spans
    it, so ids are kept for each different word; a text that holds an added
    token's string goes to the library as a whole. Marks that end a word are a word
    of their own, so letters are encoded once for all that follow them, and many of
    them in one line: the last id of each run is one that ends a word."""

    def __init__(self, path: str):
        # Tasks take all cores already; threads of the library would only compete with them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # For runs of lower-case Latin-1: nothing to normalise, and spaces are the only cuts. The model is shared.
        self.spaces = Tokenizer(self.library.model)
        self.spaces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.library.get_vocab_size() + 1, dtype=bool)
        self.ends[[i for t, i in self.library.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        return [little(array("I", e.ids)) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[str]) -> set[str]:
        """Every word of the set is in ``words`` afterwards. Returned are those not worth keeping, the long ones."""
        if len(self.words) > CACHE:
            self.older, self.words = self.words, {}
        new = self.from_older(words - self.words.keys())
        runs = [w for w in new if w.isalpha() or not w.strip(MARKS)]
        self.learn_runs(runs)
        rest = list(new.difference(runs))
        self.words.update(zip(rest, self.encode(rest)))
        return {w for some in (runs, rest) for w in some if len(w) > LONGEST}

    def from_older(self, words: set[str]) -> set[str]:
        """Takes up those that were used before; the others are returned."""
        known = words & self.older.keys()
        self.words.update((w, self.older[w]) for w in known)
        return words - known

    def learn_runs(self, runs: list[str]) -> None:
        """Runs of letters or of marks, many in one line. Each run holds one end of a word
        at least, so if there are as many ends as runs, each has its own."""
        ready = [r for r in runs if latin(r) and r == r.lower()]
        for library, part in ((self.spaces, ready), (self.library, list(set(runs).difference(ready)))):
            lines = [part[i : i + LINE] for i in range(0, len(part), LINE)]
            for line, e in zip(lines, library.encode_batch_fast(list(map(" ".join, lines)), add_special_tokens=False)):
                ids = np.array(e.ids, dtype="<u4")
                ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
                data = ids.tobytes()
                if len(ends) == len(line) and ends[-1] == len(data):
                    self.words.update([(w, data[a:b]) for w, a, b in zip(line, [0, *ends], ends)])
                else:  # a vocabulary that cuts otherwise
                    self.words.update(zip(line, self.encode(line)))

    @staticmethod
    def cut(text: str) -> list[str]:
        """Words; those of Latin-1 texts in lower case, which the library makes of them anyhow
        (elsewhere the two may differ, as for a last sigma). Marks that end a word stand alone."""
        return ENDING.sub(r" \g<0>", (text.lower() if latin(text) else text).replace("\n", " ")).split(" ")

    def of(self, texts: list[str]) -> list[bytes]:
        split = [None if "<|" in t and any(a in t for a in self.added) else self.cut(t) for t in texts]
        used = set().union(*(words for words in split if words is not None))
        passing = self.learn(used)
        known = self.words.__getitem__
        out = [self.encode([t])[0] if words is None else b"".join(map(known, words)) for t, words in zip(texts, split)]
        for word in passing:
            del self.words[word]
        return out


_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each Python worker and vocabulary."""
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]


def _pack(rows: DataFrame, examples: Callable[[pa.RecordBatch], Iterator[Example]], limits: Limits, cut: bool) -> DataFrame:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def all_examples() -> Iterator[Example]:
            for batch in pieces(batches):
                kinds.append(batch.schema.field(0).type)
                yield from examples(batch)

        bins = sequences(all_examples(), limits, cut)
        for first in bins:  # the key's type is known once a row was read
            yield from piece_rows((b for part in ([first], bins) for b in part), kinds[0])

    small_batches(rows.sparkSession)
    kind = rows.schema[0].dataType.simpleString()
    fields = ", ".join(f"`{n}` bigint" for n in PIECE_SCHEMA.names)
    return rows.mapInArrow(packed, f"doc_id {kind}, {fields}")


def pack_texts(
    df: DataFrame, path: str | None = None, limits: Limits = Limits(), end_id: int = END_ID, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Cut and pack whole texts, each followed by ``end_id``; every id bears loss.

    One row per piece: ``doc_id``, ``start`` (its text's ids before it),
    ``length``, ``ids_crc32`` over little-endian unsigned 32-bit ids,
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence,
    ``sequence_tokens`` (length of the whole sequence) and ``loss_tokens``.

    NULL and empty texts are the end id alone. Repeated rows are packed each;
    keys may be NULL. An empty table gives no rows.
    """
    path = path or tokenizer_path(VOCABULARY)
    end = np.array([end_id], dtype="<u4").tobytes()

    def examples(batch: pa.RecordBatch) -> Iterator[Example]:
        ids = word_ids(path)
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in in_blocks(texts, 512, BLOCK):
            for k, found in zip(keys[a:b], ids.of(texts[a:b])):
                found += end
                yield Example(k, found, None, 0, len(found) // 4)

    return _pack(keyed_texts(df, key, text), examples, limits, cut=True)


def pack_examples(df: DataFrame, limits: Limits = Limits(), cut: bool = False, key: str = "doc_id", ids: str = "ids", loss: str = "loss") -> DataFrame:
    """Pack tokenised examples: ``ids`` array of integers, ``loss`` array of
    booleans as long, which ids bear loss (NULL: all).

    Rows as of ``pack_texts``. Without ``cut`` examples stay whole; one that is
    over a limit by itself makes a sequence of its own, so that no row is lost.
    NULL or empty ``ids`` make no piece.
    """
    rows = df.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(ids).cast("array<bigint>"), F.array().cast("array<bigint>")).alias("ids"),
        F.col(loss).cast("array<boolean>").alias("loss"),
    )

    def examples(batch: pa.RecordBatch) -> Iterator[Example]:
        for k, i, m in zip(*(batch.column(c).to_pylist() for c in range(3))):
            mask = None if m is None else np.array([bool(x) for x in m], dtype=np.int64)
            if mask is not None and len(mask) != len(i):
                raise ValueError("loss must be as long as ids")
            yield Example(k, np.array(i, dtype="<u4").tobytes(), mask, 0, len(i))

    return _pack(rows, examples, limits, cut)
