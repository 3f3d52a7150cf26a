"""Quoted records over several lines, cut at many places, against the reader of whole files."""

import random

from staylens.sources import files, quoted

COLUMNS = ["id", "name", "note"]


def _text(rng, rows, end):
    notes = ["plain", '"two\nlines"', '"a ""q""\n\n,end"', '""', '"one, two"', "", "x, y, z", '"\n"', '"""\n"""']
    return "id,name,note" + end + "".join(f"{i},n{i},{rng.choice(notes)}{end}" for i in range(rows))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_split_records_equal_those_of_whole_files(spark, tmp_path):
    rng = random.Random(5)
    for i, rows in enumerate([0, 1, 12]):
        (tmp_path / f"{i}.csv").write_text(_text(rng, rows, "\n"))
    want = _rows(files.read_ragged_csv(spark, str(tmp_path), COLUMNS, multi_line=True))
    assert len(want) == 13
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size in (23, 100):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 2
            assert _rows(quoted.read_quoted_csv(spark, str(tmp_path), COLUMNS)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_other_line_ends_and_open_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,name,note\r\n1,a,"x\r\ny"\r\n2,b,c\r\n')
    got = _rows(quoted.read_quoted_csv(spark, str(tmp_path), COLUMNS))
    assert got == [("1", "a", "x\r\ny"), ("2", "b", "c")]
    records = quoted.read_records(spark, str(tmp_path)).where("is_first").collect()
    assert [r["record"] for r in records] == ["id,name,note"]
