"""Tables whose changes are single commits: batches with offsets, replaced slices.

A table is a folder of data folders and of numbered commits. Data is written first,
into folders of its own; then one small file, put in place by a rename, names all that
belongs to the table. A reader takes the last commit, so it sees a change whole or not
at all, and what an interrupted run left behind belongs to nothing: the next writer
removes it. The data of the last two commits stays for readers that are under way.
One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylens.sources import tables

COMMITS, DATA = "commits", "data"


class CommitError(RuntimeError):
    """A commit of this number is there already: somebody else wrote."""


@dataclass
class Snapshot:
    """What one commit names. ``parts`` has, per kind of rows, ``[folder, slice]`` pairs,
    ``batches`` the ledger."""

    number: int = 0
    schemas: dict[str, str] = field(default_factory=dict)
    parts: dict[str, list[list[str]]] = field(default_factory=dict)
    batches: list[dict] = field(default_factory=list)


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    at, files = _place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def _read_commit(spark: SparkSession, root: str, name: str) -> Snapshot:
    return Snapshot(**json.loads(spark.read.text(f"{root}/{COMMITS}/{name}", wholetext=True).first()[0]))


def _commits(spark: SparkSession, root: str) -> list[str]:
    return [n for n in _names(spark, f"{root}/{COMMITS}") if n.endswith(".json")]


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    found = _commits(spark, root)
    return _read_commit(spark, root, found[-1]) if found else Snapshot()


def publish(spark: SparkSession, root: str, new: Snapshot) -> Snapshot:
    """Make ``new`` the table's state; the last step of every change."""
    new.number += 1
    target, files = _place(spark, f"{root}/{COMMITS}/{new.number:012d}.json")
    if files.exists(target):
        raise CommitError(f"commit {new.number} of {root} is there already")
    beside, _ = _place(spark, f"{root}/{COMMITS}/.{uuid.uuid4().hex}")
    out = files.create(beside, False)
    out.write(bytearray(json.dumps(asdict(new)), "utf-8"))
    out.close()
    if not files.rename(beside, target):
        raise CommitError(f"commit {new.number} of {root} could not be put in place")
    return new


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Remove data folders that neither of the last two commits names."""
    live = {folder for name in _commits(spark, root)[-2:] for parts in _read_commit(spark, root, name).parts.values() for folder, _ in parts}
    gone = [n for n in _names(spark, f"{root}/{DATA}") if n not in live]
    for n in gone:
        at, files = _place(spark, f"{root}/{DATA}/{n}")
        files.delete(at, True)
    return gone


def _write(df: DataFrame, root: str, keys: list[str]) -> list[list[str]]:
    """Write to a new folder; its ``[folder, slice]`` pairs."""
    spark, folder = df.sparkSession, uuid.uuid4().hex
    df.write.partitionBy(*keys).parquet(f"{root}/{DATA}/{folder}")
    slices = [""]
    for _ in keys:
        slices = [f"{s}/{n}".strip("/") for s in slices for n in _names(spark, f"{root}/{DATA}/{folder}/{s}") if "=" in n]
    return [[folder, s] for s in slices]


def load(spark: SparkSession, root: str, kind: str = "rows", at: Snapshot | None = None) -> DataFrame:
    """The rows of the last commit, or of the commit ``at``."""
    state = at or snapshot(spark, root)
    schema = StructType.fromJson(json.loads(state.schemas[kind]))
    folders: dict[str, list[str]] = {}
    for folder, part in state.parts.get(kind, []):
        folders.setdefault(folder, []).append(f"{root}/{DATA}/{folder}/{part}".rstrip("/"))
    read = [spark.read.schema(schema).option("basePath", f"{root}/{DATA}/{folder}").parquet(*paths).select(*schema.names) for folder, paths in folders.items()]
    return reduce(DataFrame.unionByName, read) if read else spark.createDataFrame([], schema)


def replace_slice(df: DataFrame, root: str, keys: list[str]) -> Snapshot:
    """Replace the rows that share their ``keys`` with ``df``; all others stay, and
    neither move nor are read. ``keys`` have to be the same each time."""
    spark = df.sparkSession
    sweep(spark, root)
    state = snapshot(spark, root)
    schema = df.schema.json()
    if state.schemas.get("rows", schema) != schema:
        raise ValueError("a slice must have the columns and types of its table")
    new = _write(df, root, keys)
    replaced = {part for _, part in new}
    state.parts["rows"] = [p for p in state.parts.get("rows", []) if p[1] not in replaced] + new
    state.schemas["rows"] = schema
    return publish(spark, root, state)


def append_batch(df: DataFrame, root: str, batch: int, first: int, upto: int, schema: str, required: list[str]) -> Snapshot:
    """Append a batch of source rows ``first`` to ``upto`` (exclusive): valid ones, rejected
    ones with their failing columns, and their line in the ledger, in one commit. A batch
    that the ledger has is skipped."""
    spark = df.sparkSession
    state = snapshot(spark, root)
    if any(b["batch"] == batch for b in state.batches):
        return state
    good, rejected = tables.split_valid(df, schema, required)
    counts = {}
    for kind, rows in (("rows", good), ("rejects", rejected)):
        new = _write(rows, root, [])
        counts[kind] = spark.read.schema(rows.schema).parquet(f"{root}/{DATA}/{new[0][0]}").count()
        state.parts.setdefault(kind, []).extend(new)
        state.schemas[kind] = rows.schema.json()
    state.batches.append({"batch": batch, "first": first, "upto": upto, "loaded": counts["rows"], "rejected": counts["rejects"]})
    return publish(spark, root, state)


def append_in_batches(df: DataFrame, root: str, offset: str, size: int, schema: str, required: list[str]) -> Snapshot:
    """Append rows in batches of ``size`` offsets (a whole number per row, from 0). A run
    that is interrupted goes on, when it is repeated, with the first batch that the
    ledger lacks; a batch that fails leaves nothing. Rows without an offset go to batch -1."""
    spark = df.sparkSession
    sweep(spark, root)
    last = df.agg(F.max(offset)).first()[0]
    lost = df.where(F.col(offset).isNull())
    state = append_batch(lost, root, -1, -1, -1, schema, required) if not lost.isEmpty() else snapshot(spark, root)
    for batch in range(0 if last is None else last // size + 1):
        own = df.where((F.col(offset) >= batch * size) & (F.col(offset) < (batch + 1) * size))
        state = append_batch(own, root, batch, batch * size, (batch + 1) * size, schema, required)
    return state


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch: its offsets, and how many rows were loaded and rejected."""
    columns = ("batch", "first", "upto", "loaded", "rejected")
    return spark.createDataFrame([tuple(b[c] for c in columns) for b in snapshot(spark, root).batches], ", ".join(f"{c} bigint" for c in columns))
