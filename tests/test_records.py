"""CSV with line breaks inside fields, cut into splits anywhere."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ebbline.sources import records as rc

SCHEMA = StructType([StructField("id", IntegerType()), StructField("note", StringType()), StructField("tail", StringType())])


def drawn(seed, n):
    draw = random.Random(seed)
    parts = ["a", "é", '"', ",", "\n", "\n\n", " ", '"",', "x" * 30, ""]
    said = lambda: "".join(draw.choice(parts) for _ in range(draw.randrange(12)))
    return [(i, f"{said()}.", draw.choice(["z", said() + "!"])) for i in range(n)]


def written(rows, end="\n"):
    out = io.StringIO()
    put = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    put.writerow(SCHEMA.names)
    put.writerows(rows)
    return out.getvalue()


@pytest.fixture
def small_splits(spark):
    """Splits of a hundred bytes or so, as of a file a million times as large."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "160")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits, end):
    rows = drawn(1, 400)
    (tmp_path / "a.csv").write_text(written(rows, end), newline="")
    found = rc.read_records(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert sorted(map(tuple, found.collect())) == rows
    lines = rc._lines(spark, str(tmp_path / "a.csv"))
    assert lines.select(F.spark_partition_id()).distinct().count() > 50
    assert rc.splits(lines).where("is_open").count() > 5


def test_a_field_longer_than_several_splits(spark, tmp_path, small_splits):
    rows = [(1, "short", "z"), (2, "long\n" * 300, '"\n' * 90), (3, "after", "z"), (4, "\n" * 700, "z")]
    (tmp_path / "a.csv").write_text(written(rows))
    (tmp_path / "b.csv").write_text(written([(9, "other file\n", "z")]))
    found = rc.read_records(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], SCHEMA)
    assert sorted(map(tuple, found.collect())) == [*rows, (9, "other file\n", "z")]


def test_types_are_found_where_no_schema_is_given(spark, tmp_path):
    (tmp_path / "a.csv").write_text('i,big,x,"when, then",s,none\n1,5000000000,1.5,2023-01-01 00:00:00,a,\n\n2,3,2,2024-02-02 01:00:00,"b\nc",\n')
    found = rc.read_records(spark, str(tmp_path / "a.csv"))
    assert found.dtypes == [("i", "int"), ("big", "bigint"), ("x", "double"), ("when, then", "timestamp"), ("s", "string"), ("none", "string")]
    assert sorted(r.s for r in found.collect()) == ["a", "b\nc"]


def test_bad_records(spark, tmp_path):
    for name, text in (("many", "id,note,tail\n1,a,b,c\n"), ("type", "id,note,tail\nx,a,b\n")):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match="(?i)malformed|failfast"):
            rc.read_records(spark, str(tmp_path / name), SCHEMA).collect()
        assert rc.read_records(spark, str(tmp_path / name), SCHEMA, "PERMISSIVE").count() == 1
    (tmp_path / "empty").write_text("")
    with pytest.raises(ValueError, match="no header"):
        rc.read_records(spark, str(tmp_path / "empty"))
    (tmp_path / "head").write_text("id,note,tail\n")
    assert rc.read_records(spark, str(tmp_path / "head"), SCHEMA).collect() == []
