"""Quality gates and the scoring contract."""

import pytest
from pyspark.sql import functions as F

from ebbline.operators import gates
from ebbline.operators.gates import GateError, GatePolicy

START, END = "2023-01-01", "2023-06-01"


@pytest.fixture(scope="module")
def good(toy):
    return {"orders": toy.orders, "customers": toy.customers, "order_payments": toy.payments}


def test_good_tables_pass(good):
    assert gates.enforce_gates(good, START, END) == []


def test_missing_columns(good):
    bad = dict(good, orders=good["orders"].drop("order_id", "order_status"))
    with pytest.raises(GateError, match="orders: no column order_id, order_status"):
        gates.enforce_gates(bad, START, END)
    assert gates.enforce_gates(bad, START, END, GatePolicy(schema_checks=False)) == []


def test_empty_window(good):
    with pytest.raises(GateError, match="orders: no rows"):
        gates.enforce_gates(good, "2010-01-01", "2010-02-01")


def test_nulls_strict_and_not(good):
    nulls = good["customers"].withColumn("customer_unique_id", F.lit(None).cast("string"))
    bad = dict(good, customers=nulls)
    with pytest.raises(GateError, match="customers: 8 NULLs in customer_unique_id"):
        gates.enforce_gates(bad, START, END)
    warnings = gates.enforce_gates(bad, START, END, GatePolicy(strict=False))
    assert [(w.column_name, w.n, w.severity) for w in warnings] == [("customer_unique_id", 8, "WARN")]
    assert gates.enforce_gates(bad, START, END, GatePolicy(null_checks=False)) == []


def test_fail_fast_and_collect(good):
    bad = dict(good, orders=good["orders"].drop("order_id"), customers=good["customers"].where("false"))
    with pytest.raises(GateError) as first:
        gates.enforce_gates(bad, START, END)
    assert "orders" in str(first.value) and "customers" not in str(first.value)
    with pytest.raises(GateError) as every:
        gates.enforce_gates(bad, START, END, GatePolicy(fail_fast=False))
    assert "orders: " in str(every.value) and "customers: " in str(every.value)


def test_first_bad_column_is_reported(good):
    both = good["orders"].withColumns({c: F.lit(None).cast("string") for c in ("customer_id", "order_status")})
    with pytest.raises(GateError) as error:
        gates.enforce_gates(dict(good, orders=both), START, END, GatePolicy(fail_fast=False))
    assert "customer_id" in str(error.value) and "order_status" not in str(error.value)


def test_censoring_and_repeats(good):
    assert gates.censoring_warning(good["orders"], END, 180).count() == 0
    assert gates.censoring_warning(good["orders"], END, 365).first().check_name == "right_censored"
    assert gates.repeated_keys_warning(good["customers"]).count() == 0
    twice = good["customers"].union(good["customers"].limit(2))
    assert gates.repeated_keys_warning(twice).first().n == 2


def test_contract(spark):
    matrix = spark.createDataFrame([(1, "a", 2.0)], "customer_unique_id int, state string, money double")
    ok = gates.check_contract(matrix, ["money", "state"], ["customer_unique_id"])
    assert (ok.status, ok.missing) == ("PASSED", [])
    bad = gates.check_contract(matrix, ["zeta", "alpha", "money"], ["snapshot_date"])
    assert (bad.status, bad.missing) == ("FAILED", ["alpha", "snapshot_date", "zeta"])
    with pytest.raises(GateError, match="alpha"):
        gates.require_contract(matrix, ["alpha"])
    with pytest.raises(GateError, match="nobody to score"):
        gates.require_rows(matrix.where("false"))
    gates.require_rows(matrix)


def test_fingerprint_ignores_types_and_separators(spark):
    def of(ddl, row):
        return gates.fingerprint(spark.createDataFrame([row], ddl), START, END).first().columns_hash

    assert of("ab int, c int", (1, 2)) == of("a string, bc double", ("x", 1.0))
    assert of("ab int, c int", (1, 2)) != of("c int, ab int", (1, 2))
    assert len(of("a int", (1,))) == 10
