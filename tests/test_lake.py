"""Lake layout, pruning, availability, ingest and publishing."""

import os

import pytest
from conftest import SMALL, plan_text
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbline.functions.stamps import within_window
from ebbline.operators import gates
from ebbline.operators.features import feature_matrix
from ebbline.operators.labels import future_targets
from ebbline.sources import commits, lake
from ebbline.sources.star import commerce
from ebbline.sources.telemetry import current_telemetry, lookback_telemetry


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Two years of the small tables as a lake by day."""
    folder = str(tmp_path_factory.mktemp("lake"))
    tables = commerce(spark, SMALL)
    orders = tables.orders.where("year between 1997 and 1998")
    lake.write_lake(orders, tables.customers, tables.payments, folder)
    return folder


def test_layout_and_types(spark, base):
    assert any(d.startswith("month=0") for d in os.listdir(f"{base}/orders/year=1997"))
    orders = lake.read_table(spark, base, "orders")
    assert dict(orders.dtypes)["month"] == "int"
    assert dict(orders.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    days = orders.where(F.make_date("year", "month", "day") != F.to_date("order_purchase_timestamp"))
    assert days.count() == 0
    kept = lake.read_table(spark, base, "order_payments").join(orders, "order_id", "left_anti")
    assert kept.count() == 0


def test_one_file_per_day(base):
    folders = [files for _, _, files in os.walk(f"{base}/orders") if any(f.endswith(".parquet") for f in files)]
    assert max(sum(f.endswith(".parquet") for f in files) for files in folders) == 1


def test_windows_prune_directories(spark, base):
    orders = lake.read_table(spark, base, "orders")
    plan = within_window(orders, "order_purchase_timestamp", "1997-02-01", "1997-03-01")
    text = plan_text(plan)
    filters = text[text.index("PartitionFilters: ["):text.index("PushedFilters")]
    assert filters.count("make_date") == 2
    assert "GreaterThanOrEqual(order_purchase_timestamp" in text
    assert plan.count() == orders.where("year = 1997 and month = 2").count()


def test_features_over_the_lake_equal_features_over_the_tables(spark, base):
    tables = commerce(spark, SMALL)
    window = ("1997-01-01", "1998-07-01")
    stored = [lake.read_table(spark, base, n) for n in ("orders", "customers", "order_payments")]
    direct = tables.orders.where("year between 1997 and 1998")
    key = "customer_unique_id"

    def rows(df):
        return {r[key]: r for r in df.collect()}

    assert rows(feature_matrix(*stored, *window)) == rows(
        feature_matrix(direct, tables.customers, tables.payments, *window)
    )
    whole = rows(future_targets(*stored, "1998-01-01"))
    assert whole == rows(future_targets(*stored, "1998-01-01", sides_by_order_day=True))


def test_months_and_missing_datasets(spark, base):
    months = lake.months_present(lake.read_table(spark, base, "orders"), "1996-11-15", "1997-02-10")
    assert {tuple(r) for r in months.collect()} == {(1997, 1), (1997, 2)}
    names = ["orders", "customers", "no_such_table"]
    assert lake.missing_datasets(spark, base, names, "1997-01-01", "1997-02-01") == ["no_such_table"]
    assert lake.missing_datasets(spark, base, names[:1], "2005-01-01", "2005-02-01") == [
        "orders (No temporal overlap)"
    ]
    with pytest.raises(FileNotFoundError, match="no_such_table"):
        lake.require_datasets(spark, base, names, "1997-01-01", "1997-02-01")
    lake.require_datasets(spark, base, names[:2], "1996-12-01", "1997-01-10")


def test_unreadable_days_are_kept(spark, toy, tmp_path):
    lake.write_by_day(lake.orders_by_day(toy.orders), str(tmp_path / "orders"))
    assert spark.read.parquet(str(tmp_path / "orders")).count() == toy.orders.count()


def test_only_the_days_written_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    day = "a int, year string, month string, day string"
    lake.write_by_day(spark.createDataFrame([(1, "2023", "01", "01"), (2, "2023", "01", "02")], day), path)
    lake.write_by_day(spark.createDataFrame([(3, "2023", "01", "02")], day), path)
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 3]


def test_run_tables_are_never_overwritten(spark, tmp_path):
    df = spark.range(3)
    path = lake.write_run_table(df, str(tmp_path), "run-1")
    assert gates.row_count(spark, path) == 3
    with pytest.raises(Exception, match="already exists"):
        lake.write_run_table(df, str(tmp_path), "run-1")


def test_csv_ingest(spark, tmp_path):
    source = tmp_path / "in" / "deep"
    source.mkdir(parents=True)
    (tmp_path / "in" / "orders.csv").write_text('id,note\n1,"said ""hi"",\nthen left"\n2,\n')
    (source / "prices.csv").write_text("id,price\n1,2.5\n2,3\n")
    (source / "typed.csv").write_text("id,price\nx,2.5\n")
    (source / "empty.csv").write_text("")
    (source / "readme.txt").write_text("not a table")
    out = str(tmp_path / "out")
    schemas = {"typed": StructType.fromDDL("id int, price double")}
    (tmp_path / "in" / "prices.csv").write_text("id,price\n9,9.5\n")
    written = lake.ingest_csv(spark, str(tmp_path / "in"), out, schemas, multi_line=True)
    # An empty file is no table; two files of one name are two.
    assert written == {"orders": True, "prices": True, "deep/prices": True, "deep/typed": False}
    assert spark.read.parquet(f"{out}/raw_data/prices").count() == 1
    notes = {r.id: r.note for r in spark.read.parquet(f"{out}/raw_data/orders").collect()}
    assert notes == {1: 'said "hi",\nthen left', 2: None}
    prices = spark.read.parquet(f"{out}/raw_data/deep/prices")
    assert dict(prices.dtypes) == {"id": "int", "price": "double"}
    lake.write_csv(prices, str(tmp_path / "back"))
    assert lake.read_csv(spark, str(tmp_path / "back")).count() == 2
    # A file gone bad leaves what an earlier run made of it.
    (source / "prices.csv").write_text("id,price\n1,2.5,7,7\n")
    assert lake.ingest_csv(spark, str(tmp_path / "in"), out, schemas, multi_line=True)["deep/prices"] is False
    assert spark.read.parquet(f"{out}/raw_data/deep/prices").count() == 2


def test_publishing_a_day_is_idempotent(spark, tmp_path):
    base, day = str(tmp_path), "2023-06-01"
    first = {"telemetry": spark.range(2), "report": spark.range(5)}
    kinds = {"report": "csv"}
    assert commits.publish_day(first, base, day, kinds)
    assert commits.day_is_complete(spark, f"{base}/report", day)
    assert not commits.publish_day({"telemetry": spark.range(9), "report": spark.range(9)}, base, day, kinds)
    assert commits.read_days(spark, f"{base}/telemetry").count() == 2
    assert commits.publish_day({"telemetry": spark.range(7), "report": spark.range(1)}, base, day, kinds, rerun=True)
    assert commits.publish_day(first, base, "2023-06-02", kinds)
    counts = commits.read_days(spark, f"{base}/telemetry").groupBy("day").count().collect()
    assert {r.day: r["count"] for r in counts} == {1: 7, 2: 2}
    report = commits.read_day(spark, f"{base}/report", day)
    assert report.dtypes == [("id", "bigint")] and report.count() == 1
    assert commits.read_day(spark, f"{base}/report", "2023-06-03") is None
    assert not commits.day_is_complete(spark, f"{base}/elsewhere", day)


def test_a_publish_that_broke_off_is_done_again(spark, tmp_path):
    base, day = str(tmp_path), "2023-06-01"
    broken = spark.range(2).select(F.raise_error(F.lit("lost")).cast("string").alias("id"))
    with pytest.raises(Exception, match="lost"):
        commits.publish_day({"orders": spark.range(2), "payments": broken}, base, day)
    assert not commits.day_is_complete(spark, f"{base}/orders", day)
    assert commits.publish_day({"orders": spark.range(3), "payments": spark.range(3)}, base, day)
    assert commits.read_day(spark, f"{base}/orders", day).count() == 3


def test_a_rerun_that_broke_off_leaves_the_day_as_it_was(spark, tmp_path):
    base, day = str(tmp_path), "2023-06-01"
    assert commits.publish_day({"orders": spark.range(2), "payments": spark.range(4)}, base, day)
    held = commits.read_day(spark, f"{base}/payments", day)
    broken = spark.range(2).select(F.raise_error(F.lit("lost")).cast("string").alias("id"))
    with pytest.raises(Exception, match="lost"):
        commits.publish_day({"orders": spark.range(9), "payments": broken}, base, day, rerun=True)
    assert commits.day_is_complete(spark, f"{base}/orders", day)
    assert [commits.read_day(spark, f"{base}/{n}", day).count() for n in ("orders", "payments")] == [2, 4]
    assert commits.read_days(spark, f"{base}/orders").count() == 2
    # A later version does not pull the files away from a reader of an earlier one.
    assert commits.publish_day({"orders": spark.range(1), "payments": spark.range(1)}, base, day, rerun=True)
    assert held.count() == 4 and commits.read_day(spark, f"{base}/payments", day).count() == 1


def test_tables_of_a_day_may_be_published_apart(spark, tmp_path):
    base, day = str(tmp_path), "2023-06-01"
    commits.publish_day({"a": spark.range(1)}, base, day)
    commits.publish_day({"b": spark.range(2)}, base, day)
    commits.publish_day({"b": spark.range(3)}, base, day, rerun=True)
    assert [commits.read_days(spark, f"{base}/{n}").count() for n in "ab"] == [1, 3]


def test_days_without_telemetry(spark, tmp_path, toy):
    base = str(tmp_path / "telemetry")
    scores = spark.createDataFrame([("u1", 0.9), ("u9", 0.1)], "customer_unique_id string, predicted_probability double")
    version = commits.write_day(scores, base, "2023-06-01")
    half = current_telemetry(spark, base, "2023-06-01")
    assert (half.status, half.scores.count()) == ("SKIPPED_INCOMPLETE_DAY", 0)
    commits.commit_day({"telemetry": scores}, str(tmp_path), "2023-06-01", version)
    today = current_telemetry(spark, base, "2023-06-01")
    assert (today.scores.count(), today.status) == (2, "CURRENT_TELEMETRY_RESOLVED")
    absent = current_telemetry(spark, base, "2023-06-02")
    assert absent.status == "SKIPPED_ZERO_TRAFFIC_DAY" and absent.scores.count() == 0
    assert absent.scores.dtypes == [("customer_unique_id", "string"), ("predicted_probability", "double")]
    targets = future_targets(*toy, "2023-06-01")
    past = lookback_telemetry(spark, base, "2023-11-28", targets)
    assert past.status == "MATURED_EVALUATION_READY"
    # Whoever was scored and has no order in the window has churned.
    assert sorted(tuple(r) for r in past.labels.collect()) == [("u1", 0), ("u9", 1)]
    young = lookback_telemetry(spark, base, "2023-06-20", targets)
    assert (young.status, young.scores.count(), young.labels.count()) == ("SKIPPED_SYSTEM_IMMATURE", 0, 0)


def test_nan_becomes_null_when_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(path)
    assert lake.read_if_present(spark, path).where("x is null").count() == 1
