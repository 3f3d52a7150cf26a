"""The encounter model bound to the given tables.

Each binding is one SELECT in SQL that Spark and the oracle both run, so a
difference in a result is a difference in an operator. Keys, times and texts
come from the tables; measurements are key arithmetic that falls on both sides
of every range and rule. Lineitem repeats its keys, which gives duplicates.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import schema as S
from staylens.operators import rows
from staylens.session import configure, cut_lineage

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_GENDER = "CASE o_custkey % 4 WHEN 0 THEN ' m' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'x' END"

_ED_STAYS = f"""
SELECT l_orderkey AS stay_id,
       CASE WHEN l_quantity <> 13 THEN o_custkey END AS subject_id,
       CASE WHEN l_linestatus = 'F' AND l_quantity > 40 THEN l_orderkey END AS hadm_id,
       o_orderdate AS intime,
       CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS outtime,
       {_GENDER} AS gender,
       concat('  ', c_mktsegment) AS race,
       o_orderpriority AS arrival_transport,
       CASE WHEN l_orderkey % 97 = 0 THEN 'Expired' WHEN o_orderstatus = 'F' THEN 'Admitted'
            WHEN o_orderstatus = 'P' THEN ' transfer   to unit ' WHEN l_returnflag = 'R' THEN 'ICU'
            ELSE 'HOME' END AS disposition,
       l_shipdate AS created_at
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
     LEFT JOIN {{customer}} ON o_custkey = c_custkey
UNION ALL
SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END,
       o_orderdate, CAST(NULL AS TIMESTAMP_NTZ), {_GENDER}, CAST(NULL AS STRING), o_orderpriority,
       CASE WHEN o_orderkey % 97 = 0 THEN 'Died' ELSE 'home' END, CAST(NULL AS TIMESTAMP_NTZ)
FROM {{orders}}
"""


def _measured(columns: dict[str, str], none_when: str, **other_none_when: str) -> str:
    types = {"temperature": "DECIMAL(5,2)"}
    return ",\n       ".join(
        f"CASE WHEN NOT ({other_none_when.get(c, none_when)}) "
        f"THEN CAST({sql} AS {types.get(c, 'DECIMAL(6,2)')}) END AS {c}"
        for c, sql in columns.items()
    )


_TRIAGE_VITALS = _measured(
    {
        "temperature": "84 + (o_orderkey % 120) * 0.25",
        "heartrate": "(o_orderkey * 7 + o_custkey) % 290",
        "resprate": "(o_orderkey * 3 + o_custkey) % 90",
        "o2sat": "45 + (o_custkey * 5 + o_orderkey) % 60",
        "sbp": "(o_orderkey * 11 + o_custkey * 3) % 330",
        "dbp": "(o_orderkey * 13) % 215",
    },
    "o_orderkey % 29 = 5",
)

_TRIAGE_TAIL = f"""
       {_TRIAGE_VITALS},
       CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN ' 5  of 10 '
            ELSE CAST(o_orderkey % 11 AS STRING) END AS pain,
       CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 7 AS INT) END AS acuity,
       CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE concat(o_orderpriority, '  complaint') END AS chiefcomplaint
"""

_TRIAGE = f"""
SELECT o_orderkey AS triage_id, o_orderkey AS stay_id, o_custkey AS subject_id, {_TRIAGE_TAIL},
       o_orderdate AS created_at
FROM {{orders}}
UNION ALL
SELECT o_custkey + 1000000000, o_orderkey + 1, o_custkey, {_TRIAGE_TAIL},
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END
FROM {{orders}}
"""

_VITALS = _measured(
    {
        "temperature": "86 + (l_partkey % 110) * 0.25",
        "heartrate": "(l_partkey * 7 + l_suppkey) % 280 + l_discount",
        "resprate": "(l_partkey + l_suppkey * 3) % 90",
        "o2sat": "48 + (l_partkey * 3 + l_suppkey) % 58",
        "sbp": "(l_partkey * 5 + l_linenumber * 31) % 320",
        "dbp": "(l_partkey * 9 + 11) % 220",
    },
    "l_tax > 0.075",
    o2sat="l_returnflag = 'R'",
)

_VITAL_SIGN = f"""
SELECT l_partkey AS vital_id, l_orderkey AS stay_id, o_custkey AS subject_id,
       o_orderdate + INTERVAL '1' MINUTE * (l_linenumber * 37 + l_suppkey % 30) AS charttime,
       {_VITALS},
       CASE WHEN l_linestatus = 'F' THEN '' ELSE ' Sinus   Rhythm ' END AS rhythm,
       CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN ' ' ELSE '7' END AS pain,
       l_shipdate AS created_at
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
"""

_DIAGNOSIS = """
SELECT l_suppkey AS diagnosis_id, l_orderkey AS stay_id, o_custkey AS subject_id,
       l_linenumber AS seq_num,
       CASE WHEN l_tax = 0 THEN NULL
            WHEN p_size % 2 = 0 THEN CAST(240 + p_partkey % 400 AS STRING)
            ELSE concat(lower(substring('IJENZ', CAST(p_partkey % 5 + 1 AS INT), 1)), CAST(p_size AS STRING), ' ')
       END AS icd_code,
       CASE WHEN p_size % 2 = 0 THEN 9 ELSE 10 END AS icd_version,
       CASE WHEN l_discount = 0 THEN ' ' ELSE p_name END AS icd_title,
       l_shipdate AS created_at
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

_PYXIS = """
SELECT l_suppkey AS pyxis_id, l_orderkey AS stay_id, o_custkey AS subject_id, l_shipdate AS charttime,
       CAST(l_linenumber AS STRING) AS med_rn, concat(p_name, ' ') AS name,
       CASE WHEN l_returnflag <> 'N' THEN '1' END AS gsn_rn,
       CASE WHEN l_returnflag <> 'N' THEN p_brand END AS gsn,
       l_shipdate AS created_at
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

_MED_RECON = """
SELECT l_suppkey AS med_recon_id, l_orderkey AS stay_id, o_custkey AS subject_id, o_orderdate AS charttime,
       p_name AS name, p_brand AS gsn,
       CASE WHEN p_size > 5 THEN CAST(p_partkey % 500 AS STRING) END AS ndc,
       CAST(p_size % 3 AS STRING) AS etc_rn,
       CASE WHEN l_linestatus <> 'F' THEN CAST(p_size AS STRING) ELSE '' END AS etccode,
       p_type AS etcdescription,
       l_shipdate AS created_at
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

_SCORE = "CAST((CAST(FLOOR(o_totalprice) AS BIGINT) * {m} % 100000) * 0.00001 AS DECIMAL(6,5))"


def _prediction(model: str, version: str, multiplier: int, id_shift: int, days: str) -> str:
    score = _SCORE.replace("{m}", str(multiplier))
    return f"""
SELECT o_orderkey + {id_shift} AS risk_prediction_id, o_orderkey AS stay_id, o_custkey AS subject_id,
       '{model}' AS model_name, '{version}' AS model_version, {score} AS risk_score,
       CASE WHEN {score} >= 0.4 THEN 1 ELSE 0 END AS predicted_target,
       CASE WHEN {score} >= 0.7 THEN 'HIGH' WHEN {score} >= 0.4 THEN 'MODERATE' ELSE 'LOW' END AS risk_label,
       CAST(CASE WHEN o_orderkey % 23 = 0 THEN 7 WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderkey % 6 + 1 END AS INT) AS severity_index,
       CASE WHEN o_orderkey % 31 <> 0 THEN 'label' END AS severity_label,
       'description' AS severity_description, 'scale' AS severity_scale_name,
       CAST(0.4 AS DECIMAL(6,5)) AS threshold_used, '[]' AS top_features,
       CASE WHEN o_orderkey % 40 <> 1 THEN o_orderdate + INTERVAL '1' DAY * ({days}) END AS created_at
FROM {{orders}}
"""


_PREDICTIONS = (
    _prediction("gbt_risk", "v1", 1, 0, "o_orderkey % 60")
    + "UNION ALL"
    + _prediction("gbt_risk", "v2", 7, 1_000_000_000, "(o_orderkey * 7) % 45")
)

BINDINGS = {
    "ed_stays": _ED_STAYS,
    "triage": _TRIAGE,
    "vital_sign": _VITAL_SIGN,
    "diagnosis": _DIAGNOSIS,
    "pyxis": _PYXIS,
    "med_recon": _MED_RECON,
    "risk_predictions": _PREDICTIONS,
}


def duck(sql: str) -> str:
    """A binding in the oracle's dialect."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql.replace("TIMESTAMP_NTZ", "TIMESTAMP")


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_LINE_ORDER_PART = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey"


def line_order_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join that three bindings read, dealt once by part and once by order, which is the
    stay: whoever goes on by stay has the rows in place, from one set of shuffle files for
    all tables of a statement."""
    told = " ".join(sql for sql in BINDINGS.values() if _LINE_ORDER_PART in sql)
    used = {t: source(spark, sf_dir, t) for t in ("lineitem", "orders", "part")}
    line, orders, part = (df.select(*[c for c in df.columns if re.search(rf"\b{c}\b", told)]) for df in used.values())
    joined = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.held_together(joined)


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    if _LINE_ORDER_PART in sql:
        return spark.sql(sql.replace(_LINE_ORDER_PART, "{line_order_part}"), line_order_part=line_order_part(spark, sf_dir))
    used = {t: source(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A raw table as the landing stage stores it."""
    return written(
        spark, sf_dir, f"raw_{table}", lambda: run_sql(spark, sf_dir, BINDINGS[table])
    )


def raw_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The rows of a raw table for one pass over them: as landed, if they have been
    landed already, else straight from the given tables."""
    if is_written(spark, sf_dir, f"raw_{table}"):
        return raw(spark, sf_dir, table)
    return run_sql(spark, sf_dir, BINDINGS[table])


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: raw_rows(spark, sf_dir, t) for t in S.RAW_TABLES}


_WRITTEN: dict[tuple, object] = {}


def is_written(spark: SparkSession, sf_dir: str, name: str) -> bool:
    return (spark.sparkContext.applicationId, sf_dir, name) in _WRITTEN


def once(spark: SparkSession, sf_dir: str, name: str, build):
    """Build a value once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = build()
    return _WRITTEN[key]


def written(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The stage table ``name``, written to the shared folder on first use."""
    return once(spark, sf_dir, name, lambda: cut_lineage(build()))
