"""Not-modified revisits of a web archive: an as-of join.

A revisit record says that a server answered "not modified". It is resolved to the
latest earlier full response of the same canonical address; validators of the two
must agree; then the headers that a 304 answer may update replace those of the
response.

The join needs no window over all records of an address. Time is cut into slices;
the latest response inside the slice is found there, and the latest one before the
slice is carried from slice to slice, one row each, so an address with a third of
all records is spread over its slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.shared import stored

SLICE_ROWS = 1024
#: Headers that a 304 answer may carry to update the stored response.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Parameters that tell where a visitor came from, not what is shown.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical(url: Column) -> Column:
    """Host in lower case without ``www.`` and standard ports, path without a slash
    at its end, sorted parameters without tracking; no scheme, no fragment."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, PARTS, 1)), r"^www\.|:80$|:443$", "")
    path = F.regexp_replace(F.regexp_extract(url, PARTS, 2), "/+$", "")
    params = F.filter(F.split(F.regexp_extract(url, PARTS, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(params), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _header(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["key"] == name), F.lit(0))["value"]


def _entries(headers: Column) -> Column:
    """A header map as entries with lower-case names, sorted."""
    rows = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.coalesce(F.array_sort(rows), F.array().cast("array<struct<key:string,value:string>>"))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per revisit of ``records(record_id, url, at, kind, headers, digest)``.

    ``kind`` is ``response`` or ``revisit``, ``at`` a number, ``headers`` a map of
    strings, ``digest`` of the payload. Result: ``record_id``, ``canonical``, ``at``,
    ``status``, ``response_id``, ``response_at``, ``digest`` of the response,
    ``headers`` (``name: value`` in order of names, joined by ``; ``).

    ``status``: ``no_response`` if no full response is earlier, ``changed`` if a
    validator (ETag without its weak mark, else Last-Modified, else digest) that both
    have differs, ``unchecked`` if they share none, else ``resolved``. Only for the
    last two are headers merged; else they are the revisit's own. Of responses of
    one time the larger ``record_id`` is later; a revisit sees only times before its
    own. A NULL address is canonically empty; rows without time are never earlier
    and see nothing. Repeated revisits give a row each.
    """
    rows = records.select(
        "record_id", canonical(F.coalesce(F.col("url").cast("string"), F.lit(""))).alias("canonical"), F.col("at").cast("bigint").alias("at"),
        "kind", _entries(F.col("headers")).alias("entries"), F.col("digest").cast("string").alias("digest"),
    ).where("kind in ('response', 'revisit')")
    rows = stored(rows)
    low, high, n = rows.agg(F.min("at"), F.max("at"), F.count("*")).first()
    width = max(1, ((high or 0) - (low or 0)) * slice_rows // max(1, n))
    rows = rows.withColumn("slice", F.floor((F.coalesce("at", F.lit(low or 0)) - F.lit(low or 0)) / F.lit(width)))
    full = F.when((F.col("kind") == "response") & F.col("at").isNotNull(), F.struct("at", "record_id", "digest", "entries"))

    before = Window.partitionBy("canonical", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("found", F.max(full).over(before)).where("kind = 'revisit'")
    slices = rows.groupBy("canonical", "slice").agg(F.max(full).alias("last"))
    earlier = Window.partitionBy("canonical").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("carried", F.max("last").over(earlier)).drop("last")
    joined = inside.join(carried, ["canonical", "slice"])
    joined = joined.withColumn("r", F.when(F.col("at").isNotNull(), F.coalesce("found", "carried")))

    answers = [(_weak(_header(F.col("entries"), "etag")), _weak(_header(F.col("r.entries"), "etag")))]
    answers += [(_header(F.col("entries"), "last-modified"), _header(F.col("r.entries"), "last-modified")), (F.col("digest"), F.col("r.digest"))]
    agrees = F.coalesce(*[F.when(a.isNotNull() & b.isNotNull(), a == b) for a, b in answers])
    status = F.when(F.col("r").isNull(), "no_response").when(agrees, "resolved").when(agrees.isNull(), "unchecked").otherwise("changed")
    new = F.filter("entries", lambda e: e["key"].isin(PERMITTED))
    old = F.filter("r.entries", lambda e: ~F.exists(new, lambda x: x["key"] == e["key"]))
    merged = F.when(F.col("status").isin("resolved", "unchecked"), F.array_sort(F.concat(old, new))).otherwise(F.col("entries"))
    joined = joined.withColumn("status", status)
    return joined.select(
        "record_id", "canonical", "at", "status", F.col("r.record_id").alias("response_id"), F.col("r.at").alias("response_at"), F.col("r.digest").alias("digest"),
        F.array_join(F.transform(merged, lambda e: F.concat_ws(": ", e["key"], e["value"])), "; ").alias("headers"),
    )
