"""Queries over expressions, keep-one rules and the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import bind
from catalog.oracle import clean, guard, with_ctes
from catalog.shape import plain
from staylens import schema as S
from staylens.functions import numeric, text
from staylens.operators import rows
from staylens.plans import clean as C


# --- stage tables shared by the queries ---------------------------------------

def clean_plan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A cleaned table that is not written; its stays are."""
    rows_of = bind.raw_rows(spark, sf_dir, table)
    return C.clean_ed_stays(rows_of) if table == "ed_stays" else C.CHILD_CLEANERS[table](rows_of, cleaned(spark, sf_dir, "ed_stays"))


def cleaned(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A cleaned table as the cleaning stage writes it. Cleaning reads raw rows once, so
    they are not landed for it."""
    return bind.written(spark, sf_dir, f"cleaned_{table}", lambda: clean_plan(spark, sf_dir, table))


def cleaned_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The rows of a cleaned table for one pass over them: as written, if they have been
    already, else as a plan. Rows stay dealt by their stay there, so that duplicates and
    totals per stay need no further shuffle."""
    if table == "ed_stays" or bind.is_written(spark, sf_dir, f"cleaned_{table}"):
        return cleaned(spark, sf_dir, table)
    return clean_plan(spark, sf_dir, table)


def counted_tables(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Raw and cleaned tables that are only counted: nothing but the stays is written."""
    stays = cleaned(spark, sf_dir, "ed_stays")
    raw = {t: bind.raw_rows(spark, sf_dir, t) for t in S.RAW_TABLES}
    return raw, {t: stays if t == "ed_stays" else clean_plan(spark, sf_dir, t) for t in S.RAW_TABLES}


def cleaned_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: cleaned(spark, sf_dir, t) for t in S.RAW_TABLES}


# --- text ----------------------------------------------------------------------

def q_clean_text(spark, sf):
    df = bind.source(spark, sf, "documents")
    return df.select("doc_id", text.clean_text(F.col("text")).alias("text_clean"))


O_CLEAN_TEXT = f"SELECT doc_id, {clean('text')} AS text_clean FROM documents"


def q_normalize_category(spark, sf):
    df = bind.source(spark, sf, "orders")
    g = F.expr(bind._GENDER)
    return df.select(
        "o_orderkey", text.normalize_category(g, S.GENDERS, S.UNKNOWN).alias("gender")
    ).transform(lambda d: rows.one_hot(d, "gender", {"gender_male": "Male", "gender_unknown": "Unknown"}))


O_NORMALIZE_CATEGORY = f"""
SELECT o_orderkey, gender, CAST(gender = 'Male' AS INT) AS gender_male,
       CAST(gender = 'Unknown' AS INT) AS gender_unknown
FROM (SELECT o_orderkey, CASE upper(trim({bind._GENDER})) WHEN 'M' THEN 'Male' WHEN 'MALE' THEN 'Male'
        WHEN 'F' THEN 'Female' WHEN 'FEMALE' THEN 'Female' ELSE 'Unknown' END AS gender FROM orders)
"""


def q_clean_code(spark, sf):
    dx = bind.raw(spark, sf, "diagnosis")
    out = dx.groupBy(
        text.clean_code(F.col("icd_code")).alias("icd_code"),
        text.default_text(text.clean_text(F.col("icd_title")), S.UNKNOWN_DIAGNOSIS).alias("icd_title"),
    )
    return out.agg(F.count("*").alias("row_count"))


O_CLEAN_CODE = with_ctes(f"""
SELECT upper({clean('icd_code')}) AS icd_code, coalesce({clean('icd_title')}, 'Unknown diagnosis') AS icd_title,
       COUNT(*) AS row_count
FROM raw_diagnosis GROUP BY 1, 2
""")

# Text forms of numbers, as a raw file holds them, from one lineitem row.
_TEXT_NUMBER = """CASE l_linenumber WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS STRING) WHEN 2 THEN 'abc'
  WHEN 3 THEN concat(' ', CAST(l_orderkey AS STRING), '.5 ') WHEN 4 THEN 'nan' WHEN 5 THEN '' WHEN 6 THEN 'inf'
  ELSE '"7"' END"""


def q_coerce_numbers(spark, sf):
    df = bind.source(spark, sf, "lineitem")
    raw = F.expr(_TEXT_NUMBER)
    value = text.to_number(raw)
    return df.groupBy(
        "l_linenumber",
        value.isNull().alias("is_null"),
        text.sentinels_to_null(text.strip_quotes(raw)).isNull().alias("is_sentinel"),
    ).agg(
        F.count("*").alias("row_count"), F.sum(value).alias("total"),
        F.sum(F.length(text.strip_quotes(raw))).alias("chars"),
    )


O_COERCE_NUMBERS = f"""
SELECT l_linenumber, v IS NULL AS is_null,
       coalesce(replace(raw, '"', '') IN ('', 'nan', 'None'), true) AS is_sentinel,
       COUNT(*) AS row_count, SUM(v) AS total,
       CAST(SUM(length(replace(raw, '"', ''))) AS BIGINT) AS chars
FROM (SELECT *, CASE WHEN isfinite(n) THEN n END AS v
      FROM (SELECT l_linenumber, raw, TRY_CAST(trim(raw) AS DOUBLE) AS n
            FROM (SELECT l_linenumber, {_TEXT_NUMBER} AS raw FROM lineitem)))
GROUP BY 1, 2, 3
"""


# --- ranges and rescaling --------------------------------------------------------

def q_range_guard_flags(spark, sf):
    raw = bind.raw(spark, sf, "triage").select("triage_id", "stay_id", *S.CLEAN_RANGES)
    return plain(rows.add_missing_flags(rows.guard_ranges(raw, S.CLEAN_RANGES), list(S.CLEAN_RANGES)))


O_RANGE_GUARD_FLAGS = with_ctes(f"""
SELECT triage_id, stay_id,
       {', '.join(f'CAST({v} AS DOUBLE) AS {v}' for v in S.VITALS)}, acuity,
       {', '.join(f'{v} IS NULL AS {v}_missing' for v in S.CLEAN_RANGES)}
FROM (SELECT triage_id, stay_id, {', '.join(guard(c) for c in S.CLEAN_RANGES)} FROM raw_triage)
""")

# A measurement with misplaced decimal points, zeros and negatives.
_WILD = {
    "temperature": "CAST(CASE WHEN l_linenumber = 3 THEN 10 ELSE 1 END * (840 + l_partkey % 300) AS DOUBLE) / 10",
    "heartrate": "CAST((l_partkey * 7) % 300 - 10 AS DOUBLE)",
    "resprate": "CAST(l_partkey % 80 AS DOUBLE)",
    "o2sat": "CAST(CASE WHEN l_linenumber = 2 THEN 1000 + l_partkey ELSE l_partkey % 130 END AS DOUBLE)",
    "sbp": "CAST(CASE l_linenumber WHEN 1 THEN 1208 WHEN 2 THEN 12080 WHEN 4 THEN 151103 ELSE 0 END + l_suppkey * 3 AS DOUBLE)",
    "dbp": "CAST(CASE l_linenumber WHEN 1 THEN 748 WHEN 2 THEN 7481 WHEN 4 THEN 74810 ELSE 0 END + l_suppkey AS DOUBLE)",
}


def _wild(spark, sf):
    return bind.source(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", *[F.expr(e).alias(c) for c, e in _WILD.items()]
    ).distinct()


_WILD_SQL = (
    "SELECT DISTINCT l_partkey, l_suppkey, l_linenumber, "
    + ", ".join(f"{e} AS {c}" for c, e in _WILD.items()) + " FROM lineitem"
)


def q_rescale_steps(spark, sf):
    df = _wild(spark, sf)
    return df.withColumns({c: numeric.rescale_steps(F.col(c), st) for c, st in S.RESCALE_STEPS.items()})


O_RESCALE_STEPS = f"""
SELECT l_partkey, l_suppkey, l_linenumber, heartrate, resprate,
       CASE WHEN temperature > 200 THEN temperature / 10 ELSE temperature END AS temperature,
       CASE WHEN o2sat > 1000 THEN o2sat / 10 ELSE o2sat END AS o2sat,
       CASE WHEN s1 > 1000 THEN s1 / 10 ELSE s1 END AS sbp,
       CASE WHEN d2 > 200 AND d2 <= 1000 THEN d2 / 10 ELSE d2 END AS dbp
FROM (SELECT *, CASE WHEN d1 > 1000 AND d1 <= 10000 THEN d1 / 100 ELSE d1 END AS d2
      FROM (SELECT *, CASE WHEN sbp > 1000 THEN sbp / 10 ELSE sbp END AS s1,
                   CASE WHEN dbp > 10000 THEN dbp / 1000 ELSE dbp END AS d1 FROM ({_WILD_SQL})))
"""


def q_rescale_until(spark, sf):
    df = _wild(spark, sf)
    return df.select(
        "l_partkey", "l_suppkey", "l_linenumber",
        *[numeric.rescale_until(F.col(c), lo, hi).alias(c) for c, (lo, hi) in S.RESCALE_UNTIL.items()],
    )


def _until(c: str) -> str:
    lo, hi = S.RESCALE_UNTIL[c]
    x, whens = c, [f"WHEN {c} <= {hi} THEN {c}"]
    for _ in range(8):
        x = f"({x} / 10)"
        whens.append(f"WHEN {x} <= {hi} THEN {x}")
    v = f"CASE {' '.join(whens)} END"
    return f"CASE WHEN {v} BETWEEN {lo} AND {hi} THEN {v} END AS {c}"


O_RESCALE_UNTIL = f"""
SELECT l_partkey, l_suppkey, l_linenumber, {_until('sbp')}, {_until('dbp')} FROM ({_WILD_SQL})
"""


def q_clip_values(spark, sf):
    df = rows.guard_ranges(_wild(spark, sf), S.RAW_RANGES)
    nulled = df.withColumn("sbp", numeric.zero_to_null(F.col("sbp")))
    return nulled.withColumns({c: numeric.clip(F.col(c), *b) for c, b in S.RAW_CLIP.items()})


def _raw_guard(c: str) -> str:
    if c not in S.RAW_RANGES:
        return f"nullif({c}, 0)" if c == "sbp" else c
    lo, hi = S.RAW_RANGES[c]
    top = f" AND {c} <= {hi}" if hi is not None else ""
    return f"CASE WHEN {c} >= {lo}{top} THEN {c} END"


O_CLIP_VALUES = f"""
SELECT l_partkey, l_suppkey, l_linenumber,
       {', '.join(f'CASE WHEN {c} IS NOT NULL THEN greatest({lo}, least({hi}, {c})) END AS {c}' for c, (lo, hi) in S.RAW_CLIP.items())}
FROM (SELECT l_partkey, l_suppkey, l_linenumber, {', '.join(f'{_raw_guard(c)} AS {c}' for c in _WILD)} FROM ({_WILD_SQL}))
"""


# --- keep-one rules ---------------------------------------------------------------

def q_require_any(spark, sf):
    v = bind.raw(spark, sf, "vital_sign")
    guarded = rows.guard_ranges(v, {c: S.CLEAN_RANGES[c] for c in S.VITALS})
    return rows.require_any(guarded, S.VITALS).groupBy("stay_id").agg(
        F.count("*").alias("row_count"),
        F.sum(numeric.completeness(*[F.col(c) for c in S.VITALS])).alias("filled"),
    )


O_REQUIRE_ANY = with_ctes(f"""
SELECT stay_id, COUNT(*) AS row_count,
       CAST(SUM({' + '.join(f'CAST({v} IS NOT NULL AS INT)' for v in S.VITALS)}) AS BIGINT) AS filled
FROM (SELECT stay_id, {', '.join(guard(v) for v in S.VITALS)} FROM raw_vital_sign)
WHERE {' OR '.join(f'{v} IS NOT NULL' for v in S.VITALS)} GROUP BY stay_id
""")


def q_require_keys(spark, sf):
    raw = bind.raw(spark, sf, "ed_stays")
    return plain(rows.require_not_null(raw, ["stay_id", "subject_id", "intime"]))


O_REQUIRE_KEYS = with_ctes("""
SELECT * REPLACE (epoch_us(intime) AS intime, epoch_us(outtime) AS outtime, epoch_us(created_at) AS created_at)
FROM raw_ed_stays WHERE stay_id IS NOT NULL AND subject_id IS NOT NULL AND intime IS NOT NULL
""")


def _table_sql(table: str, times: list[str], decimals: list[str]) -> str:
    parts = [f"epoch_us({t}) AS {t}" for t in times] + [f"CAST({d} AS DOUBLE) AS {d}" for d in decimals]
    return with_ctes(f"SELECT * REPLACE ({', '.join(parts)}) FROM {table}")


def q_completeness_best(spark, sf):
    return plain(C.clean_ed_stays(bind.raw(spark, sf, "ed_stays")))


O_COMPLETENESS_BEST = _table_sql("cleaned_ed_stays", ["intime", "outtime", "created_at"], [])


def q_earliest_per_key(spark, sf):
    return plain(C.clean_triage(bind.raw(spark, sf, "triage"), cleaned(spark, sf, "ed_stays")))


O_EARLIEST_PER_KEY = _table_sql("cleaned_triage", ["created_at"], S.VITALS)


def q_latest_per_key(spark, sf):
    p = rows.keep_latest(
        bind.raw(spark, sf, "risk_predictions"), ["stay_id"], "created_at", "risk_prediction_id"
    )
    return plain(p.select("stay_id", "subject_id", "risk_score", "risk_label", "created_at"))


O_LATEST_PER_KEY = _table_sql("latest_predictions", ["created_at"], ["risk_score"])


def _dedupe_query(table):
    def query(spark, sf):
        return plain(C.CHILD_CLEANERS[table](bind.raw(spark, sf, table), cleaned(spark, sf, "ed_stays")))

    return query


def q_semi_child(spark, sf):
    stays = cleaned(spark, sf, "ed_stays")
    kept = rows.keep_children(bind.raw(spark, sf, "triage"), stays, "stay_id")
    return kept.groupBy("stay_id").agg(F.count("*").alias("row_count"))


O_SEMI_CHILD = with_ctes("""
SELECT stay_id, COUNT(*) AS row_count FROM raw_triage
WHERE stay_id IN (SELECT stay_id FROM cleaned_ed_stays) GROUP BY stay_id
""")


def q_orphan_count(spark, sf):
    stays = cleaned(spark, sf, "ed_stays")
    return rows.union_all(
        [
            rows.orphans(bind.raw(spark, sf, t), stays, "stay_id")
            .agg(F.count("*").alias("orphan_stay_id_rows"))
            .select(F.lit(t).alias("child_table"), "orphan_stay_id_rows")
            for t in S.CHILD_TABLES
        ]
    )


O_ORPHAN_COUNT = with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS child_table, COUNT(*) AS orphan_stay_id_rows FROM raw_{t} c "
    "LEFT JOIN cleaned_ed_stays e ON c.stay_id = e.stay_id WHERE e.stay_id IS NULL"
    for t in S.CHILD_TABLES
))

QUERIES = {
    "clean_text": q_clean_text,
    "normalize_category": q_normalize_category,
    "clean_code": q_clean_code,
    "coerce_numbers": q_coerce_numbers,
    "range_guard_flags": q_range_guard_flags,
    "rescale_steps": q_rescale_steps,
    "rescale_until": q_rescale_until,
    "clip_values": q_clip_values,
    "require_any": q_require_any,
    "require_keys": q_require_keys,
    "completeness_best": q_completeness_best,
    "earliest_per_key": q_earliest_per_key,
    "latest_per_key": q_latest_per_key,
    "dedupe_vital_sign": _dedupe_query("vital_sign"),
    "dedupe_diagnosis": _dedupe_query("diagnosis"),
    "dedupe_pyxis": _dedupe_query("pyxis"),
    "dedupe_med_recon": _dedupe_query("med_recon"),
    "semi_child": q_semi_child,
    "orphan_count": q_orphan_count,
}
ORACLES = {
    "clean_text": O_CLEAN_TEXT,
    "normalize_category": O_NORMALIZE_CATEGORY,
    "clean_code": O_CLEAN_CODE,
    "coerce_numbers": O_COERCE_NUMBERS,
    "range_guard_flags": O_RANGE_GUARD_FLAGS,
    "rescale_steps": O_RESCALE_STEPS,
    "rescale_until": O_RESCALE_UNTIL,
    "clip_values": O_CLIP_VALUES,
    "require_any": O_REQUIRE_ANY,
    "require_keys": O_REQUIRE_KEYS,
    "completeness_best": O_COMPLETENESS_BEST,
    "earliest_per_key": O_EARLIEST_PER_KEY,
    "latest_per_key": O_LATEST_PER_KEY,
    "dedupe_vital_sign": _table_sql("cleaned_vital_sign", ["charttime", "created_at"], S.VITALS),
    "dedupe_diagnosis": _table_sql("cleaned_diagnosis", ["created_at"], []),
    "dedupe_pyxis": _table_sql("cleaned_pyxis", ["charttime", "created_at"], []),
    "dedupe_med_recon": _table_sql("cleaned_med_recon", ["charttime", "created_at"], []),
    "semi_child": O_SEMI_CHILD,
    "orphan_count": O_ORPHAN_COUNT,
}
