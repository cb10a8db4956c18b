"""Every query of the plain catalogue against its DuckDB oracle over the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from dealspark import catalogue
from dealspark.operators import selection

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


def _plain(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, list):
        return str([_plain(x) for x in value])
    if value is None or value is pd.NaT or value is pd.NA or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, float):
        return f"{value:.8g}"
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return str(value)


def _rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(_plain(v) for v in row) for row in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_oracle(spark, duck, name):
    got, expected = catalogue.QUERIES[name](spark, SF).toPandas(), duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert _rows(got) == _rows(expected)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs_without_oracle(spark, name):
    out = catalogue.QUERIES[name](spark, SF)
    assert out.count() > 0 and len(set(out.columns)) == len(out.columns)


def test_fuzzy_first_wins_equals_a_greedy_pass(spark):
    parts = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_name").toPandas().sort_values("p_partkey")
    kept = {}
    for key, name in parts.itertuples(index=False, name=None):
        name = name.lower()
        if not any(name == k or min(len(name), len(k)) >= 6 and (name in k or k in name) for k in kept.values()):
            kept[key] = name
    assert {r["p_partkey"] for r in catalogue.QUERIES["fuzzy_first_wins"](spark, SF).collect()} == set(kept)


def test_balanced_quota_reads_all_candidates(spark, tmp_path):
    nations = [(n, f"N{n}", 2 if n in (6, 7) else 1) for n in range(8)]
    # one nation holds the 300 best balances
    customers = [(i, f"C{i:04}", 0 if i < 300 else i % 8, float(9000 - i if i < 300 else i * 37 % 800)) for i in range(700)]
    customers += [customers[-1]] * 15
    spark.createDataFrame(nations, "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame(customers, "c_custkey int, c_name string, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    rows = [{"category": f"N{n}", "name": name, "penalty": -balance, "domestic": n in (6, 7), "earlier": n % 3} for _, name, n, balance in customers]
    want = [(r["category"], r["name"], r["domestic"]) for r in selection.balanced_quota(rows, 12, 4)]
    got = catalogue.QUERIES["balanced_quota"](spark, str(tmp_path)).orderBy("rank").collect()
    assert [(r["category"], r["name"], r["domestic"]) for r in got] == want
    assert {c for c, _, _ in want} == {f"N{n}" for n in range(8)} and sum(d for _, _, d in want) >= 4


def test_entry_has_a_stable_schema(spark):
    first, second = catalogue.flagship(spark, SF), catalogue.flagship(spark, SF)
    assert first.schema == second.schema and first.collect() == second.collect()
