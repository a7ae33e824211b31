"""Every registered query that has SQL, against DuckDB on the test tables."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_module

DATA = Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")

from ratelab.operators import classifiers
from ratelab.plans import model_queries, registry

QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(map(repr, row)) for row in pdf.astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, str(DATA)).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    assert canonical(got) == canonical(want)


def test_entry_and_key_sets(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.queries())
    assert entry_module.entry(spark).first()["triangles"] == 10932


def test_known_values(spark):
    sf_dir = str(DATA)
    assert QUERIES["triangle_count"](spark, sf_dir).first()["triangles"] == 8590
    assert QUERIES["triangle_count_unfiltered"](spark, sf_dir).first()["triangles"] == 8738
    assert QUERIES["triangle_count_simple"](spark, sf_dir).first()["triangles"] == 8374
    row = QUERIES["metrics_milli"](spark, sf_dir).first()
    assert row["n"] == 4778
    assert (row["ape_milli"], row["sape_milli"], row["se_milli"]) == (4681756, 1273345, 40747042)
    assert (row["mape"], row["smape"], row["rmse"]) == (97.985684, 26.650167, 2.920283)


def test_unpruned_tree_equals_sql(spark, duck):
    train, test = model_queries._train_test(spark, str(DATA))
    got = classifiers.fit_tree(train, unpruned=True).predict(test)
    got = got.selectExpr("row_key", "CAST(rating AS DOUBLE) AS actual", "predicted").toPandas()
    want = duck.execute(model_queries._gain_tree_sql(unpruned=True)).df()
    assert len(got) > 0 and canonical(got) == canonical(want)
