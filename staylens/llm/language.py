"""Language of web pages by Bayesian evidence fusion.

The posterior of a page's language is the product of

* the likelihood of its visible text, from byte trigrams counted per language on
  labelled texts, tempered so that a long text speaks like ``EVIDENCE`` trigrams;
* the likelihood of the language that its markup declares, from how often each
  declaration goes with each language;
* the prior of its host, smoothed towards the prior of the address's suffix, which
  is smoothed towards the prior of all pages.

Declarations, suffixes and hosts are summed up by grouped aggregation of the text's
own posteriors; a page's own share is taken out of its priors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.shared import stored, text_of

SLOTS = 1 << 15
EVIDENCE = 40
#: Labelled texts for the trigram counts (bound), those of the smallest hashes.
SAMPLE = 20_000
#: Pages' worth of the wider level in each smoothed prior.
WEIGHT = 4.0

HIDDEN = re.compile(r"(?is)<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*>")
COMMENT = re.compile(r"(?s)<!--.*?(?:-->|\Z)")
#: Tags are consumed whole, so that many openings without an end are read once.
HTML_TAG = re.compile(r"(?i)<html\b[^>]*")
LANG = re.compile(r"(?i)\blang\s*=\s*[\"']?\s*([a-z]{2,3})")


def visible(html: str) -> str:
    return HIDDEN.sub(" ", html)


def declared(html: str) -> str | None:
    """The language of the first html tag that names one, outside comments."""
    for tag in HTML_TAG.finditer(COMMENT.sub(" ", html)):
        if found := LANG.search(tag[0]):
            return found[1].lower()
    return None


def trigrams(text: str) -> np.ndarray:
    """Slots of the byte trigrams of the lower-cased text, runs of other signs as one space."""
    b = np.frombuffer(re.sub(r"[\W\d_]+", " ", f" {text.lower()} ").encode("utf-8"), np.uint8).astype(np.int64)
    return (b[:-2] * 31 * 257 + b[1:-1] * 257 * 5 + b[2:]) % SLOTS


def likelihoods(documents: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and log likelihood of each trigram slot under each of them."""
    rows = documents.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), text_of(text).alias("text"), F.xxhash64(key, text).alias("h"))
    bound = [r[0] for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]
    if not bound:
        return [], np.zeros((SLOTS, 0))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total.setdefault(name, np.zeros(SLOTS, dtype=np.int64))
                total[name] += np.bincount(trigrams(text_), minlength=SLOTS)
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["lang", "slot", "n"])

    parts = rows.where(F.col("h") <= bound[-1]).select("lang", "text").mapInArrow(counted, "lang string, slot int, n bigint")
    found = parts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()  # languages times slots at most
    langs = sorted({r["lang"] for r in found} | {r[0] for r in rows.select("lang").distinct().collect()})
    counts = np.full((SLOTS, len(langs)), 0.1)
    for r in found:
        counts[r["slot"], langs.index(r["lang"])] += r["n"]
    return langs, np.log(counts / counts.sum(axis=0))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def page_evidence(pages: DataFrame, langs: list[str], table: np.ndarray, key: str, url: str, html: str) -> DataFrame:
    """``(page_id, host, suffix, declared, loglik)`` per page."""
    rows = pages.select(F.col(key).alias("page_id"), text_of(html).alias("html"), text_of(url).alias("url"))
    kind = rows.schema["page_id"].dataType.simpleString()
    known = set(langs)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, suffixes, marks, logs = [], [], [], []
            for text, address in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = trigrams(visible(text))
                logs.append(table[found].sum(axis=0) * min(1.0, EVIDENCE / max(1, len(found))))
                host = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#:]*)", address)[1].lower()
                hosts.append(host)
                suffixes.append(host.rsplit(".", 1)[-1])
                mark = declared(text)
                marks.append(mark if mark in known else "other" if mark else "none")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hosts, pa.string()), pa.array(suffixes, pa.string()), pa.array(marks, pa.string()), pa.array(logs, pa.list_(pa.float64()))],
                ["page_id", "host", "suffix", "declared", "loglik"],
            )

    return rows.mapInArrow(read, f"page_id {kind}, host string, suffix string, declared string, loglik array<double>")


def _normal(x: Column) -> Column:
    """Log weights to probabilities."""
    e = lambda c: F.transform(c, lambda v: F.exp(v - F.array_max(c)))
    return F.transform(e(x), lambda v: v / F.aggregate(e(x), F.lit(0.0), lambda s, w: s + w))


def identify(pages: DataFrame, documents: DataFrame, sample: int = SAMPLE, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: ``page_id``, ``lang``, ``probability``, ``text_lang`` (by the text
    alone), ``declared`` (``none``, ``other`` or a language), ``host``.

    NULL and empty pages are decided by host, suffix and all pages. Without any
    labelled text ``lang`` is NULL. Repeated rows count each and get equal results;
    ties go to the language first in the alphabet.
    """
    langs, table = likelihoods(documents, sample)
    n = len(langs)
    seen = page_evidence(pages, langs, table, key, url, html)
    if not n:
        return seen.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    seen = stored(seen.withColumn("own", _normal(F.col("loglik"))))

    sums = [F.sum(F.col("own")[i]) for i in range(n)]
    hosts = seen.groupBy("suffix", "host").agg(F.array(*sums).alias("in_host"))
    hosts = stored(hosts)
    total = lambda c: [F.sum(F.col(c)[i]) for i in range(n)]
    suffixes = stored(hosts.groupBy("suffix").agg(F.array(*total("in_host")).alias("in_suffix")))
    in_all = [float(x or 0) for x in suffixes.agg(*total("in_suffix")).first()]
    by_mark = {r["declared"]: r["n"] for r in seen.groupBy("declared").agg(F.array(*sums).alias("n")).collect()}  # languages + 2 rows at most
    marks = sorted(by_mark)
    held = np.array([by_mark[m] for m in marks]).reshape(len(marks), n) + 0.5
    log_mark = np.log(held / held.sum(axis=0))

    prior = F.lit([(x + 1.0) / (sum(in_all) + n) for x in in_all])
    rest = lambda c: F.zip_with(c, "own", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    size = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + v)
    smooth = lambda counts, wider: F.zip_with(counts, wider, lambda c, w: (c + WEIGHT * w) / (size(counts) + WEIGHT))
    mark = F.lit(None).cast("array<double>")
    for m, row in zip(marks, log_mark):
        mark = F.when(F.col("declared") == m, F.lit([float(v) for v in row])).otherwise(mark)

    joined = seen.join(stored(hosts.join(suffixes, "suffix")), ["suffix", "host"])
    joined = joined.withColumn("_suffix", rest("in_suffix")).withColumn("_host", rest("in_host"))
    joined = joined.withColumn("_prior", smooth(F.col("_suffix"), prior)).withColumn("_prior", smooth(F.col("_host"), F.col("_prior")))
    log = F.zip_with(F.zip_with("loglik", mark, lambda a, b: a + b), "_prior", lambda a, b: a + F.log(b))
    joined = joined.withColumn("_log", log).withColumn("_p", _normal(F.col("_log")))
    name = lambda c: F.get(F.lit(langs), F.array_position(c, F.array_max(c)).cast("int") - 1)
    return joined.select("page_id", name(F.col("_p")).alias("lang"), F.array_max("_p").alias("probability"), name(F.col("own")).alias("text_lang"), "declared", "host")
