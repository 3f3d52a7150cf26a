"""Commits: readers see a change whole or not at all, interrupted runs are taken up again."""

import pytest
from pyspark.sql import functions as F

from staylens.sources import ledger

SCHEMA, REQUIRED = "id bigint, amount decimal(6,2)", ["id"]


def source(spark, n):
    rows = [(i, str(i) if i % 7 else "x", None if i % 5 == 0 else str(i / 4)) for i in range(n)]
    return spark.createDataFrame(rows, "at bigint, id string, amount string")


def state(spark, root):
    rows = sorted((r["id"], r["amount"]) for r in ledger.load(spark, root).where("amount IS NOT NULL").collect())
    return rows, sorted(r["at"] for r in ledger.load(spark, root, "rejects").collect()), [tuple(r) for r in ledger.ledger(spark, root).collect()]


def test_batches_are_loaded_once(spark, tmp_path):
    df, a, b = source(spark, 100), str(tmp_path / "a"), str(tmp_path / "b")
    ledger.append_in_batches(df, a, "at", 30, SCHEMA, REQUIRED)
    ledger.append_in_batches(df.where("at < 60"), b, "at", 30, SCHEMA, REQUIRED)
    ledger.append_in_batches(df, b, "at", 30, SCHEMA, REQUIRED)
    ledger.append_in_batches(df, b, "at", 30, SCHEMA, REQUIRED)
    assert state(spark, a) == state(spark, b)
    _, rejects, lines = state(spark, a)
    assert rejects == [i for i in range(100) if i % 7 == 0]
    assert [x[:3] for x in lines] == [(0, 0, 30), (1, 30, 60), (2, 60, 90), (3, 90, 120)] and sum(x[3] for x in lines) + len(rejects) == 100


@pytest.mark.parametrize("step", ["rejects", "publish", "rename"])
def test_a_batch_that_fails_leaves_nothing(spark, tmp_path, monkeypatch, step):
    """Fails after the rows were written, before the commit, and inside it."""
    df, a, b = source(spark, 100), str(tmp_path / "a"), str(tmp_path / "b")
    ledger.append_in_batches(df, a, "at", 40, SCHEMA, REQUIRED)
    ledger.append_in_batches(df.where("at < 40"), b, "at", 40, SCHEMA, REQUIRED)
    before = state(spark, b)
    calls = []
    name = "_write" if step == "rejects" else "publish"
    real = getattr(ledger, name)

    def broken(*args):
        calls.append(args)
        if step == "rejects" and len(calls) < 2:
            return real(*args)
        if step == "rename":
            at, files = ledger._place(spark, f"{b}/{ledger.COMMITS}/.left")
            files.create(at, False).close()  # what a writer leaves that ends before its rename
        raise OSError("lost")

    monkeypatch.setattr(ledger, name, broken)
    with pytest.raises(OSError, match="lost"):
        ledger.append_in_batches(df, b, "at", 40, SCHEMA, REQUIRED)
    assert state(spark, b) == before
    monkeypatch.undo()
    ledger.append_in_batches(df, b, "at", 40, SCHEMA, REQUIRED)
    assert state(spark, a) == state(spark, b)
    folders = {f for parts in ledger.snapshot(spark, b).parts.values() for f, _ in parts}
    assert set(ledger._names(spark, f"{b}/{ledger.DATA}")) == folders  # orphans are gone


def test_rows_without_offset_and_empty_sources(spark, tmp_path):
    root = str(tmp_path / "t")
    df = source(spark, 3).withColumn("at", F.when(F.col("at") > 0, F.col("at")))
    ledger.append_in_batches(df, root, "at", 10, SCHEMA, REQUIRED)
    ledger.append_in_batches(df, root, "at", 10, SCHEMA, REQUIRED)
    assert [tuple(r)[:1] + tuple(r)[3:] for r in ledger.ledger(spark, root).collect()] == [(-1, 0, 1), (0, 2, 0)]
    empty = str(tmp_path / "e")
    assert ledger.append_in_batches(df.limit(0), empty, "at", 10, SCHEMA, REQUIRED).number == 0
    assert ledger.ledger(spark, empty).count() == 0


def slices(spark, root, at=None):
    return sorted(map(tuple, ledger.load(spark, root, at=at).collect()), key=str)


def test_a_slice_is_replaced_in_one_commit(spark, tmp_path, monkeypatch):
    root, columns = str(tmp_path / "s"), "model string, version string, id bigint"
    make = lambda *rows: spark.createDataFrame(rows, columns)
    first = ledger.replace_slice(make(("m", "1", 1), ("m", "1", 2), ("m", "2", 3), (None, "a/b=c", 4)), root, ["model", "version"])
    old = slices(spark, root)
    assert len(old) == 4
    reader = ledger.load(spark, root)
    untouched = {tuple(p) for p in ledger.snapshot(spark, root).parts["rows"] if p[1] != "model=m/version=1"}
    monkeypatch.setattr(ledger, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ledger.replace_slice(make(("m", "1", 9)), root, ["model", "version"])
    assert slices(spark, root) == old
    monkeypatch.undo()
    ledger.replace_slice(make(("m", "1", 9)), root, ["model", "version"])
    assert slices(spark, root) == sorted([("m", "1", 9), ("m", "2", 3), (None, "a/b=c", 4)], key=str)
    assert untouched <= {tuple(p) for p in ledger.snapshot(spark, root).parts["rows"]}
    # Who read the table before the change can still finish, and the older state can be read.
    assert sorted(map(tuple, reader.collect()), key=str) == old == slices(spark, root, first)
    ledger.replace_slice(make((None, "a/b=c", 5)), root, ["model", "version"])
    assert (None, "a/b=c", 5) in slices(spark, root) and (None, "a/b=c", 4) not in slices(spark, root)
    with pytest.raises(ValueError, match="columns"):
        ledger.replace_slice(make(("m", "1", 1)).withColumn("more", F.lit(1)), root, ["model", "version"])


def test_two_writers_of_one_number(spark, tmp_path):
    root = str(tmp_path / "w")
    df = spark.createDataFrame([("m", 1)], "model string, id bigint")
    ledger.replace_slice(df, root, ["model"])
    one, other = ledger.snapshot(spark, root), ledger.snapshot(spark, root)
    ledger.publish(spark, root, one)
    with pytest.raises(ledger.CommitError):
        ledger.publish(spark, root, other)
