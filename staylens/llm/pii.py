"""Personal data: candidates from generators of high recall, chosen by boosted trees.

Base spans follow fixed formats and always stay. Beside them, looser generators
propose spans that no base span covers: telephone numbers without +, addresses with
a spelled-out @, long digit runs. Boosted trees score each such free proposal from
its format and from what stands around it. Their labels come from rewritten texts
(``planted``): in place, addresses and telephone numbers of the base formats are
given obfuscated, unprefixed or unbroken forms (positive), and number series,
versions, times and phrases of the text's own words are put in between (negative). A
text without an address or number gets a made one, so that every kind is learned on
any texts. Of what stands free by itself only what is known to be no personal data
has a label: card-shaped numbers that fail their check and values of tokens and
versions. Margins are calibrated per kind on the free spans of texts that the trees
have not seen, and per kind the lowest threshold is taken that keeps the wanted
precision there. Chosen spans that overlap a base span or a likelier one are dropped.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.boosting import Boosted, platt, sigmoid
from staylens.llm.shared import keyed_texts, pieces, small_batches, stored

#: Base formats, in the order in which kinds are listed. An ip begins where
#: its run of digits does, as the leftmost match does anyhow; said so, long runs are read once.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOOSE = {
    "email_like": re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?[(\[{]\s?(?:at|AT|@)\s?[)\]}]\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|[(\[{]\s?(?:dot|DOT)\s?[)\]}])\s?[A-Za-z0-9-]{1,63}){1,4}"),
    "phone_like": re.compile(r"(?<![0-9A-Za-z])\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4})?(?![0-9A-Za-z])"),
    "number_like": re.compile(r"(?<![0-9A-Za-z.])[0-9](?:[ -]?[0-9]){8,18}(?![0-9A-Za-z])"),
}
KINDS = [*BASE, *LOOSE]
WORDS_NEAR = re.compile(r"(?i)\b(?:tel|phone|call|fax|mobile|cell|contact|mail|e-mail|email|write|card|visa|account|iban|ssn|passport|id|ip|host|address|login|from|server)\b")
CODE_NEAR = re.compile(r"(?i)(?:=|token|key|secret|password|hash|version|sha|uuid|#)\W{0,3}$")

#: Texts that the trees are fitted on (bound), and the share of them kept for calibration.
SAMPLE_TEXTS = 4000
CALIBRATION = 0.3
PRECISION = 0.98


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def passes(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    if kind == "card":
        number = digits(found)
        return 13 <= len(number) <= 19 and luhn(number)
    if kind == "phone":
        return 9 <= len(digits(found)) <= 15
    return True


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches per kind without overlap; those that fail their check are dropped."""
    out = []
    number = any(c in text for c in "0123456789")
    for kind, pattern in BASE.items():
        if kind == "email" and "@" not in text or kind != "email" and not number or kind == "phone" and "+" not in text:
            continue
        out += [(kind, m.start(), m.end()) for m in (addresses(text) if kind == "email" else pattern.finditer(text)) if passes(kind, m[0])]
    return out


def addresses(text: str) -> Iterator[re.Match]:
    """Matches of the address pattern, looked for only where an @ stands: from the
    first character before it that an address may hold, but not before the last match."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := BASE["email"].match(text, start)):
            yield m
            after = m.end()
        at = text.find("@", max(at + 1, after))


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def proposals(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "(" in text or "[" in text or "{" in text:
        out += [("email_like", m.start(), m.end()) for m in LOOSE["email_like"].finditer(text)]
    if any(c in text for c in "0123456789"):
        out += [(k, m.start(), m.end()) for k in ("phone_like", "number_like") for m in LOOSE[k].finditer(text)]
    return out


def features(text: str, span: tuple[str, int, int]) -> list[float]:
    kind, a, b = span
    s, before, after = text[a:b], text[max(0, a - 40) : a], text[b : b + 20]
    number, n = digits(s), max(1, b - a)
    groups = [len(g) for g in re.findall(r"[0-9]+", s)]
    last, next_ = before[-1:] or " ", after[:1] or " "
    return [
        float(KINDS.index(kind)), n, len(number), len(number) / n, len(groups), max(groups, default=0), min(groups, default=0),
        s.count("-"), s.count(" "), s.count("."), s.count("(") + s.count("["), sum(c.isalpha() for c in s) / n,
        len(set(number)), float(number[:1] in ("4", "5", "3")), float(number[:1] == "0"),
        float(last.isspace()), float(last.isalnum()), float(last in "=:\"'/#"),
        float(next_.isspace()), float(next_.isalnum()), float(next_ in ".,;"), float(next_ in "\"'/"),
        float(bool(WORDS_NEAR.search(before))), float(bool(CODE_NEAR.search(before))),
        float(bool(re.search(r"\.\s", s))), float("dot" in s.lower()), float(len(re.findall(r"\w*$", s)[0])), float(bool(re.search(r"\W[A-Z][a-z]*$", s))), *[float(g) for g in [*groups, 0, 0, 0, 0][:4]],
    ]


def obfuscated(address: str, rng: random.Random) -> str:
    """An address with its @, and often its dots, spelled out."""
    local, host = address[:64].split("@", 1)
    at = rng.choice(["(at)", " (at) ", "[at]", " [at] ", "{at}", " (AT) ", "(@)", " [@] "])
    return local + at + rng.choice([".", " (dot) ", "(dot)", "[dot]", " [DOT] "]).join(host.split(".")[-4:])


def national(number: str, rng: random.Random) -> str:
    """A telephone number without its +, in one of the forms of national use, or unbroken."""
    a, b, c = number[-10:-7], number[-7:-4], number[-4:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}) {b} {c}", f"{a} {b}-{c}", a + b + c, a + b + c])


def decoys(near: list[str], rng: random.Random) -> list[str]:
    """One string per generator that it proposes and that is no personal data."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    year, w = rng.randint(1700, 2100), [re.sub(r"[^A-Za-z]+", "", x)[:20] or "noon" for x in near]
    card = "4" + n(15)
    series = rng.choice([f"{year} {year + 1} {year + 2}", f"{year}-{year + 4} {year + 9}", f"{rng.randint(10, 99)}.{n(3)}.{n(3)}", f"{rng.randint(10, 999)} {n(3)} {n(3)}", f"{n(4)}-{n(4)}-{n(4)}", f"{n(2)}.{n(4)}.{n(4)}"])
    run = rng.choice([card if not luhn(card) else card[:-1] + str((int(card[-1]) + 1) % 10), f"1{rng.randint(4, 7)}{n(11)}", n(12), n(14), n(18), f"{year}{n(10)}"])
    phrase = f"{w[0].lower()} {rng.choice(['(at)', '[at]', '(AT)', '(@)'])} {w[1].lower()}. {w[2].capitalize()}"
    return [phrase, rng.choice(["", "", "version ", "order #", "ref: "]) + series, rng.choice(["", "", "token=", "#"]) + run]


def planted(text: str, rng: random.Random) -> tuple[str, list[tuple[int, int, float]]]:
    """The text with its addresses and telephone numbers in free forms and decoys in
    between, and where these stand: start, end, 1 for personal data, else 0."""
    base, words_ = base_spans(text), text.split()[:400] or ["noon"]
    gaps = [m.end() for m in re.finditer(r"\s", text) if all(m.end() <= a or m.end() >= b for _, a, b in base)] or [len(text)]
    put, end = [], 0
    for kind, a, b in sorted(base, key=lambda s: s[1]):
        if a >= end and kind in ("email", "phone"):
            number = digits(text[a:b])
            if kind == "email" or len(number) >= 10:
                put.append((a, b, obfuscated(text[a:b], rng) if kind == "email" else national(number, rng), 1.0))
                end = b
    pick = lambda: re.sub(r"[^A-Za-z]+", "", rng.choice(words_))[:20].lower() or "info"
    made = [(d, 0.0) for d in decoys([rng.choice(words_) for _ in range(3)], rng)]
    if not any(k == "email" for k, _, _ in base):
        made.append((obfuscated(f"{pick()}{rng.choice(['', '.', '_'])}{rng.choice([pick(), str(rng.randint(1, 99))])}@{pick()}.{rng.choice(['com', 'org', 'net', 'de', 'example.com', 'co.uk'])}", rng), 1.0))
    if not any(k == "phone" for k, _, _ in base):
        made.append((national("".join(rng.choice("0123456789") for _ in range(10)), rng), 1.0))
    put += [(at, at, s, y) for at, (s, y) in zip((rng.choice(gaps) for _ in made), made) if not any(a < at < b for a, b, _, _ in put)]
    out, where, at, size = [], [], 0, 0
    for a, b, s, y in sorted(put, key=lambda x: x[:2]):
        before = text[at:a] + (" " if a == b else "")
        out += [before, s, " " if a == b else ""]
        where.append((size + len(before), size + len(before) + len(s), y))
        size, at = size + sum(map(len, out[-3:])), b
    return "".join([*out, text[at:]]), where


def examples_of(text: str, rng: random.Random, most: int = 200) -> list[tuple[str, float, list[float]]]:
    """Kind, label and features of the free proposals of the planted text that have a
    label; of those that stand there by themselves ``most`` at most."""
    text, where = planted(text, rng)
    base, out, own = base_spans(text), [], 0
    for s in proposals(text):
        if any(s[1] < b and a < s[2] for _, a, b in base):
            continue
        over = [y for a, b, y in where if s[1] < b and a < s[2]]
        number = digits(text[s[1] : s[2]])
        if not over and own < most and (CODE_NEAR.search(text[max(0, s[1] - 40) : s[1]]) or s[0] == "number_like" and 13 <= len(number) <= 19 and not luhn(number)):
            over, own = [0.0], own + 1
        if len(set(over)) == 1:
            out.append((s[0], over[0], features(text, s)))
    return out


@dataclass
class Model:
    """Trees, and per kind of proposal slope and offset of its calibration and a threshold; none of other kinds is taken."""

    trees: Boosted
    scales: dict[str, tuple[float, float]]
    thresholds: dict[str, float]

    def chosen(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        found = proposals(text)
        free = [s for s in found if s[0] in self.thresholds and all(s[2] <= a or s[1] >= b for _, a, b in base)]
        if not free:
            return []
        slope, offset = np.array([self.scales[s[0]] for s in free]).T
        p = sigmoid(slope * self.trees.margin(np.array([features(text, s) for s in free], dtype=float)) + offset)
        taken: list[tuple[str, int, int]] = []
        for i in np.argsort(-p, kind="stable"):
            kind, a, b = free[i]
            if p[i] >= self.thresholds[kind] and all(b <= x or a >= y for _, x, y in taken):
                taken.append(free[i])
        return sorted(taken, key=lambda s: (KINDS.index(s[0]), s[1]))


def learned(rows: DataFrame, sample: int = SAMPLE_TEXTS, precision: float = PRECISION) -> Model:
    """Fit on at most ``sample`` texts: those of the smallest hashes among all that
    hold a digit, an @ or an opening bracket, filled up with others.

    A threshold is taken only where enough held-out spans speak for the precision:
    it is estimated with one more right and one more wrong span than were seen.
    """
    hashed = rows.select("text", (~F.col("text").rlike(r"[0-9@(\[{]")).alias("plain"), F.xxhash64("text", F.lit(7)).alias("h")).where("text <> ''")
    bound = hashed.select("plain", "h").distinct().orderBy("plain", "h").limit(sample).collect()
    empty = Model(Boosted(), {}, {})
    if not bound:
        return empty

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out += [(h, *e) for e in examples_of(text, random.Random(h))]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.float64(), pa.list_(pa.float64())))], ["h", "kind", "y", "x"])

    # One row per different text, so that copies don't weigh more.
    texts = hashed.where(F.struct("plain", "h") <= F.struct(*map(F.lit, bound[-1]))).groupBy("h").agg(F.first("text").alias("text"))
    found = texts.mapInArrow(examples, "h bigint, kind string, y double, x array<double>").orderBy("h", "kind", "x").collect()
    if len({r["y"] for r in found}) < 2:
        return empty
    x, y = np.array([r["x"] for r in found]), np.array([r["y"] for r in found])
    held = np.array([r["h"] % 1000 < 1000 * CALIBRATION for r in found])
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        return empty
    trees = Boosted().fit(x[~held], y[~held])
    margin, labels = trees.margin(x[held]), y[held]
    kinds = np.array([r["kind"] for r in found])[held]
    scales, thresholds = {}, {}
    for kind in LOOSE:
        mine = kinds == kind
        if len(set(labels[mine])) < 2:
            continue
        slope, offset = platt(margin[mine], labels[mine])
        p = sigmoid(slope * margin[mine] + offset)
        right = lambda t: (labels[mine][p >= t].sum() + 1) / ((p >= t).sum() + 2)  # noqa: E731, B023
        at = [t for t in [0.5, *np.unique(p[p > 0.5])] if right(t) >= precision]
        if at:
            scales[kind], thresholds[kind] = (slope, offset), float(at[0])
    return Model(trees, scales, thresholds)


def as_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(df: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base
    spans), ``base_sha256``, ``spans`` (all, ``kind:start:end`` by kind, then start;
    code points, end exclusive) and ``n_added``.

    NULL and empty texts have no spans. Rows are read alone, so repeated ones get
    the same result, and a NULL key stays NULL.
    """
    rows = keyed_texts(df, key, text)
    model = model or learned(rows)
    names = ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            base = [base_spans(t) for t in batch.column(1).to_pylist()]
            more = [model.chosen(t, b) for t, b in zip(batch.column(1).to_pylist(), base)]
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in BASE]
            digests = pa.array([hashlib.sha256(as_text(b).encode()).hexdigest() for b in base], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, digests, pa.array([as_text(b + m) for b, m in zip(base, more)], pa.string()), pa.array([len(m) for m in more], pa.int64())], names
            )

    counts = ", ".join(f"n_{k} bigint" for k in BASE)
    return rows.mapInArrow(found, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string, n_added bigint")


def redacted(text: str, model: Model) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced as one, by the first one's kind."""
    base = base_spans(text)
    spans = sorted(base + model.chosen(text, base), key=lambda s: (s[1], -s[2]))
    out, at, end = [], 0, 0
    for kind, a, b in spans:
        if a >= end:
            out += [text[at:a], f"[{kind.removesuffix('_like').upper()}]"]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """``df`` with personal data in its text replaced; no row goes, other columns
    stay. NULL stays NULL."""
    small_batches(df.sparkSession)
    model = model or learned(df.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))
    at = df.columns.index(text)

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [None if t is None else redacted(t, model) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return df.mapInArrow(replaced, df.schema)
