import duckdb

import __spark_entry__ as contract
from catalog import QUERIES


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    without = set(QUERIES) - set(contract.oracle_sql())
    assert without == {
        "gbt_metrics", "lasso_coefs", "model_compare", "predict_report", "ranked_forest",
        "rf_importance", "sequence_forest",
    }


def test_the_flagship_matches_its_sql(spark):
    got = contract.entry(spark).toPandas()
    base = duckdb.connect()
    for name in ("lineitem", "supplier", "nation", "orders", "customer"):
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    want = base.execute(contract.oracle_sql()["state_month_wide_yield"]).df()
    keys = ["State", "Year"]
    got = got.sort_values(keys).reset_index(drop=True)
    want = want.sort_values(keys).reset_index(drop=True)[list(got.columns)]
    assert len(got) and got.equals(want.astype(got.dtypes))
