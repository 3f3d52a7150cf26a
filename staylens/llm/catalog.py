"""Registered queries of the corpus operators. Each reads its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from staylens.llm import decontaminate, exact_dedup, hard_negatives, language, manifest, packing, pii, quality, revisit, simhash, sketches, substring, token_counts
from staylens.llm.shared import documents


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text that loses something; all others stay as they are."""
    return substring.without_repeats(documents(spark, sf_dir))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(documents(spark, sf_dir))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: How much later than a page its revisit is.
REVISIT_AFTER = 5000


def captures(pages: DataFrame) -> DataFrame:
    """Each page as a full response at the time of its number, and one revisit of it
    later, by another form of its address, with the validator that the page had."""
    tag = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    page = pages.select("page_id", "url", tag.alias("tag"), F.char_length(F.coalesce("html", F.lit(""))).cast("string").alias("size"))
    response = page.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.col("page_id").alias("at"), F.lit("response").alias("kind"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), "size", F.lit("ETag"), "tag", F.lit("Date"), F.col("page_id").cast("string")).alias("headers"),
        F.col("tag").alias("digest"),
    )
    at = F.col("page_id") + REVISIT_AFTER
    again = page.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"), at.alias("at"), F.lit("revisit").alias("kind"),
        F.create_map(F.lit("Date"), at.cast("string"), F.lit("ETag"), F.concat(F.lit("W/"), "tag"), F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return response.union(again)


def op9_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisit.resolve(captures(spark.read.parquet(f"{sf_dir}/pages.parquet")))


OP9_SQL = r"""
WITH parts AS (
  SELECT page_id, md5(coalesce(html, '')) AS tag, CAST(length(coalesce(html, '')) AS VARCHAR) AS size,
    regexp_replace(lower(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)', 1)), '^www\.|:80$|:443$', '', 'g') AS host,
    regexp_replace(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)', 2), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&') AS query
  FROM pages
), page AS (
  SELECT page_id, tag, size, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical FROM parts
), found AS (
  SELECT v.page_id, v.canonical, v.tag, r.page_id AS r_id, r.tag AS r_tag, r.size AS r_size,
    row_number() OVER (PARTITION BY v.page_id ORDER BY r.page_id DESC NULLS LAST) AS k
  FROM page v LEFT JOIN page r ON r.canonical = v.canonical AND r.page_id < v.page_id + 5000
)
SELECT page_id * 2 + 1 AS record_id, canonical, page_id + 5000 AS "at",
  CASE WHEN r_id IS NULL THEN 'no_response' WHEN tag = r_tag THEN 'resolved' ELSE 'changed' END AS status,
  r_id * 2 AS response_id, r_id AS response_at, r_tag AS digest,
  CASE WHEN tag = r_tag
    THEN 'cache-control: max-age=60; content-length: ' || r_size || '; content-type: text/html; date: ' || (page_id + 5000) || '; etag: W/' || tag
    ELSE 'cache-control: max-age=60; content-length: 0; date: ' || (page_id + 5000) || '; etag: W/' || tag END AS headers
FROM found WHERE k = 1
""".replace("\\\\", "\\")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hundredth row is an anchor; where 7 divides the key, the label is shifted by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, label=label)


OP11_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS k
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(k AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10
"""


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(documents(spark, sf_dir))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides crc32 of the key, the row claims one character more than it has."""
    return manifest.manifest(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


_ENCODED = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in manifest.FIELDS]
_LEAF = f"sha256({' || '.join(_ENCODED)})"
_CLAIMED = _LEAF.replace("n_chars", "(n_chars + 1)")
# The CRC-32 remainders of the sixteen half bytes.
_CRC = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
    "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)
_STEP = f"xor({_CRC}[1 + CAST(xor(c, x) & 15 AS INT)], c >> 4)"
_STEP = f"list_transform([{_STEP}], lambda c: xor({_CRC}[1 + CAST(xor(c, x >> 4) & 15 AS INT)], c >> 4))[1]"
_CRC32 = f"xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda b: CAST(ascii(b) AS BIGINT)), lambda c, x: {_STEP}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _tree(name: str, leaves: str) -> str:
    """Levels of a tree of pairs per group ``g``."""
    return f"""{name} AS (
  SELECT g, 0 AS lvl, i, leaf AS h, n FROM {leaves}
  UNION ALL
  SELECT g, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY g, lvl, i // 2, n
)"""


def _steps(name: str, tree: str, leaves: str) -> str:
    """The siblings of each leaf, with their side."""
    return f"""{name} AS (
  SELECT d.id, list(CASE WHEN s.h IS NULL THEN 'A' WHEN o.i % 2 = 1 THEN 'L' || s.h ELSE 'R' || s.h END ORDER BY o.lvl) AS w
  FROM {leaves} d JOIN {tree} o ON o.g = d.g AND o.n > 1 AND o.i = d.i >> o.lvl LEFT JOIN {tree} s ON s.g = o.g AND s.lvl = o.lvl AND s.i = xor(o.i, 1)
  GROUP BY d.id
)"""


OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g, {_LEAF} AS leaf,
    CASE WHEN {_CRC32} % 7 = 0 AND n_chars IS NOT NULL THEN {_CLAIMED} END AS claimed FROM documents
), l AS MATERIALIZED (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d
), {_tree("t", "l")}, {_steps("w", "t", "l")}, u AS (
  SELECT g AS name, '' AS g, h AS leaf, row_number() OVER (ORDER BY g) AS id, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1
), {_tree("v", "u")}, {_steps("x", "v", "u")}, r AS (SELECT h AS root FROM v WHERE n = 1), f AS (
  SELECT l.*, u.leaf AS subroot, r.root, list_concat(coalesce(w.w, []), coalesce(x.w, [])) AS path
  FROM l JOIN u ON u.name = l.g CROSS JOIN r LEFT JOIN w ON w.id = l.id LEFT JOIN x ON x.id = u.id
), z AS (
  SELECT *, list_reduce(path, lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END), coalesce(claimed, leaf)) AS folded_root FROM f
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM z
"""


QUERIES = {q.__name__: q for q in (
    op1_quality, op2_token_counts, op3_substring_dedup, op4_fingerprints, op5_simhash_near_dedup,
    op6_language, op7_packing, op8_decontamination, op9_revisits, op10_pii, op11_hard_negatives, op12_exact_dedup, op13_manifest,
)}

QUERIES["pipeline"] = corpus_pipeline.run

ORACLES: dict[str, str] = {"op9_revisits": OP9_SQL, "op11_hard_negatives": OP11_SQL, "op12_exact_dedup": OP12_SQL, "op13_manifest": OP13_SQL}
