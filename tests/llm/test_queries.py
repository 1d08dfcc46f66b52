"""Every query with SQL equals it, and every query gives each row of its table once."""

import pytest
from compare import differences, duck
from conftest import SMALL

from ebbline.llm.catalog import ORACLE, QUERIES

MIDDLE = "/root/testdata/sf0.01"
TABLE_OF = {"op2": ("pages", "page_id"), "op9": ("embeddings", "vec_id"), "op13": ("conversations", "conv_id")}


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name, folder):
    ours = QUERIES[name](spark, folder).toPandas()
    theirs = duck(folder).execute(ORACLE[name]).fetchdf()
    assert differences(ours[list(theirs.columns)], theirs) is None


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "op11_phrases"))
def test_every_row_once(spark, name):
    table, key = TABLE_OF.get(name.split("_")[0], ("documents", "doc_id"))
    got = QUERIES[name](spark, SMALL).select(key).toPandas()[key]
    want = spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).toPandas()[key]
    # One row a conversation; one row for every row of the other tables.
    assert sorted(got) == sorted(want.unique() if table == "conversations" else want)
