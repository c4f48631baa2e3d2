"""Registered queries against their SQL on the smallest tables."""
import pathlib
import re

import duckdb
import pytest

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, db, name):
    df = entry.queries()[name](spark, sf_dir)
    result = db.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), names)


UNPROVEN = sorted(n for n in set(entry.queries()) - set(ORACLES) if not re.match(r"op\d+_|pipeline$", n))


@pytest.mark.parametrize("name", UNPROVEN)
def test_runs_without_sql(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 2


def test_ticker_files_of_every_symbol(spark, sf_dir, monkeypatch):
    from cohortlens.plans import source_queries, tables

    read, seen = source_queries.prices.read_ticker_files, []
    monkeypatch.setattr(source_queries.prices, "read_ticker_files", lambda s, f, names: seen.extend(names) or read(s, f, names))
    entry.queries()["ticker_files"](spark, sf_dir)
    assert set(seen) == {r["symbol"] for r in tables.prices(spark, sf_dir).select("symbol").distinct().collect()} and len(seen) > 3
