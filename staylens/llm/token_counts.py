"""Token counts by dynamic programming over prefixes.

A byte-pair encoding of any text ends in one token that is decided by the text
alone, and two tokens may stand side by side exactly if encoding their joined
bytes gives the two back. So the last token of every prefix follows from the
last tokens of shorter prefixes: try the tokens that end the prefix, longest
first, and take the one that may follow the last token of what is left. The
count at each prefix is one more than the count before its last token. The
table answers how many tokens any prefix has and how far a budget reaches,
and nothing is encoded again for another budget.

Tables are made once for each different run of spaces and word ("chunk") and
kept in a bounded cache of the Python worker; a text is a sum over its chunks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from staylens.llm.shared import in_blocks, keyed_texts, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Chunks whose tables one Python worker keeps: so many newer ones, and as many used before them.
CACHE = 400_000

#: The pattern of the byte-level vocabulary. White space is written out, since libraries differ on it.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: A piece never runs from a visible character into white space, so a text may be cut there.
CHUNKS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
WHITE = re.compile(f"[{SPACE}]*")
NEVER = 1 << 30


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte:
    the byte's own Latin-1 character if it is visible, else the next free one
    from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounts:
    """Exact token counts at every byte prefix of a text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        merges = [(raw(a), raw(b)) for a, b in spec["model"]["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.halves = {a + b: (a, b, i) for i, (a, b) in enumerate(merges)}
        self.ends: tuple[dict, dict] = ({}, {})
        self.tokens = {raw(t) for t in spec["model"]["vocab"]}
        self.tokens = {t for t in self.tokens if len(t) == 1 or t in self.halves and not self.crossed(*self.halves[t])}
        self.longest = max(map(len, self.tokens))
        self.may_follow: dict[tuple[bytes, bytes], bool] = {}
        self.chunks: dict[str, bytes | list[int]] = {}
        self.older: dict[str, bytes | list[int]] = {}
        self.latest: tuple[bytes, list[int], list[bytes]] = (b"", [0], [b""])

    def end_parts(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at the left (0) or right (1) end of a token while
        it is merged, each with the rank of the merge that takes it up."""
        known = self.ends[side].get(token)
        if known is None:
            known, part, until = [], token, NEVER
            while True:
                known.append((part, until))
                if part not in self.halves:
                    break
                *both, until = self.halves[part]
                part = both[side]
            self.ends[side][token] = known
        return known

    def crossed(self, before: bytes, after: bytes, below: int = NEVER) -> bool:
        """Whether a merge of lower rank than ``below`` joins parts of both. Of
        equal ranks the merge further left comes first."""
        for x, x_until in self.end_parts(before, 1):
            for y, y_until in self.end_parts(after, 0):
                rank = self.ranks.get((x, y), NEVER)
                if rank < below and rank < x_until and rank <= y_until:
                    return True
        return False

    def fits(self, before: bytes, after: bytes) -> bool:
        pair = (before, after)
        known = self.may_follow.get(pair)
        if known is None:
            if len(self.may_follow) > 500_000:
                self.may_follow.clear()
            known = self.may_follow[pair] = not self.crossed(before, after)
        return known

    def piece(self, data: bytes) -> list[int]:
        """Token counts of ``data[:i]`` for i from 0 to its length. The prefix that it
        shares with the piece before it is not computed again."""
        before, counts, last = self.latest
        shared = 0
        for a, b in zip(before, data):
            if a != b:
                break
            shared += 1
        counts, last = counts[: shared + 1], last[: shared + 1]
        tokens, fits, longest = self.tokens, self.fits, self.longest
        for end in range(shared + 1, len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = data[start:end]
                if token in tokens and (not start or fits(last[start], token)):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        if len(data) < 100:
            self.latest = data, counts, last
        return counts[:]

    def table(self, chunk: str) -> list[int]:
        """Counts at every byte prefix of a chunk, each as if the text ended there.

        White space at the end of a text is one piece, while its last character
        leaves it when a word follows; so its prefixes are counted by themselves.
        """
        if chunk.isalpha() or chunk[0] == " " and chunk[1:].isalpha():  # one piece
            return self.piece(chunk.encode("utf-8"))
        white = WHITE.match(chunk)[0]
        counts, base, at = [0, 1][: len(white) + 1] if white in ("", " ") else self.piece(white.encode("utf-8")), 0, 0
        for piece in PIECES.findall(chunk):
            own = self.piece(piece.encode("utf-8"))
            if piece in ("'re", "'ve", "'ll"):  # cut short, the mark and the letter are pieces of their own
                own[2] = 2
            counts += [base + n for n in own[max(1, len(counts) - at) :]]
            base += own[-1]
            at += len(own) - 1
        return counts

    def of_chunk(self, chunk: str) -> bytes | list[int]:
        known = self.chunks.get(chunk)
        if known is None:
            known = self.older.get(chunk)
            if known is None:
                known = self.table(chunk)
                known = bytes(known) if known[-1] < 256 else known
            if len(chunk) < 100:
                if len(self.chunks) >= CACHE:
                    self.older, self.chunks = self.chunks, {}
                self.chunks[chunk] = known
        return known

    def cut(self, text: str) -> list[str | None]:
        """A text's chunks; None stands for an added token, which counts as one."""
        out: list[str | None] = []
        at = 0
        marks = self.special_split.finditer(text) if "<|" in text else ()
        for span in [*((m.start(), m.end()) for m in marks), (len(text), len(text))]:
            part = text[at : span[0]] if at or span[0] < len(text) else text
            out += CHUNKS.findall(part)
            if span[1] > span[0]:
                out.append(None)
            at = span[1]
        return out

    def count_all(self, texts: list[str], limit: int) -> list[tuple[int, int]]:
        """Per text, its tokens and how many bytes the longest prefix of at most ``limit`` tokens has."""
        cuts = list(map(self.cut, texts))
        new = {c for chunks in cuts for c in chunks if c not in self.chunks}
        new.discard(None)
        if len(self.chunks) + len(new) > CACHE:
            self.older, self.chunks = self.chunks, {}
            new = {c for chunks in cuts for c in chunks if c is not None}
        for chunk in sorted(new):  # in this order neighbours share long prefixes
            self.of_chunk(chunk)
        return [self.count(t, chunks, limit) for t, chunks in zip(texts, cuts)]

    def count(self, text: str, chunks: list[str | None], limit: int) -> tuple[int, int]:
        known = self.chunks
        try:
            totals = [known[c][-1] for c in chunks]
        except KeyError:
            totals = [1 if c is None else self.of_chunk(c)[-1] for c in chunks]
        total = sum(totals)
        if total <= limit:
            return total, len(text.encode("utf-8"))
        reach = 0
        for chunk, size, after in zip(chunks, totals, accumulate(totals)):
            if after > limit:
                left = limit - (after - size)
                if chunk is not None:
                    table = self.of_chunk(chunk)
                    reach += max(i for i, n in enumerate(table) if n <= left)
                break
            reach += len(self.special[0]) if chunk is None else len(chunk.encode("utf-8"))
        return total, reach


_COUNTERS: dict[str, PrefixCounts] = {}


def counter(path: str) -> PrefixCounts:
    """One for each Python worker and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounts(path)
    return _COUNTERS[path]


def token_counts(df: DataFrame, path: str | None = None, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` and
    ``limit_bytes``, the bytes of the longest prefix of at most ``limit`` tokens
    (a code point may be cut by it).

    NULL and empty texts have 0 tokens. Repeated rows are counted each; a NULL
    key stays NULL. Nothing is shuffled and no text is cut short.
    """
    path = path or tokenizer_path(VOCABULARY)
    rows = keyed_texts(df, key, text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [x for a, b in in_blocks(texts) for x in counts.count_all(texts[a:b], limit)]
            n = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                    n,
                    pa.array([x[0] > limit for x in found], pa.bool_()),
                    pa.array([x[1] for x in found], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "limit_bytes"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, limit_bytes bigint")
