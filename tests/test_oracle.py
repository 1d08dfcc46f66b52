"""Every relational query equals its SQL on the generated tables."""

import pytest
from compare import differences, duck
from conftest import SMALL

from ebbline.catalog.oracle import ORACLE
from ebbline.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, con, name):
    ours = QUERIES[name](spark, SMALL).toPandas()
    theirs = con.execute(ORACLE[name]).fetchdf()
    assert differences(ours, theirs) is None


def test_only_model_fits_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == {
        "tuned_model", "trained_scores", "calibrated_scores", "permutation_importance", "mean_contributions",
    }
    assert set(ORACLE) <= set(QUERIES)


def test_report_order(spark):
    rows = QUERIES["business_report"](spark, SMALL).collect()
    known = [r for r in rows if r.revenue_at_risk is not None]
    assert rows[: len(known)] == known and 0 < len(known) < len(rows)
    keys = [(-r.revenue_at_risk, r.customer_unique_id) for r in known]
    assert keys == sorted(keys)
