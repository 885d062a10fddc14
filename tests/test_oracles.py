"""Every query of the catalogue beside its SQL counterpart on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from loadweave.plans import catalogue


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_as_sql(spark, duck, sf_dir, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    found = duck.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, found.fetchall())


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_models_have_production_settings(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalogue.regress, "translate", lambda *a: (a[-1], a[-1]))
    for name in ("regression_pipeline", "regression_metrics"):  # the others take parts of these
        used = catalogue.QUERIES[name](spark, sf_dir)
        assert (used.trees, used.depth, used.epochs, used.folds) == (100, None, 50, 5)


def test_whole_tables_are_read(spark, duck, sf_dir):
    total = duck.execute("SELECT sum(value) FROM events").fetchone()[0]
    days = catalogue.QUERIES["daily_resample_all"](spark, sf_dir).collect()
    assert math.isclose(sum(r["v"] for r in days), total, rel_tol=1e-9)
    pairs = catalogue.QUERIES["pair_set_compare_all"](spark, sf_dir).first()
    assert pairs["n_pairs"] == duck.execute("SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)").fetchone()[0]
