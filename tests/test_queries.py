"""Every named query against its SQL in another engine, over the same tables."""

import math
import os

import duckdb
import pytest

from tallyfold.plans import ledger_queries, oracles, page_queries, queries, reader_queries, register_queries, store_queries

_MORE = (register_queries, page_queries, ledger_queries, reader_queries, store_queries)
QUERIES = queries.QUERIES | {k: v for m in _MORE for k, v in m.QUERIES.items()}
ORACLE_SQL = oracles.ORACLE_SQL | {k: v for m in _MORE for k, v in m.ORACLE_SQL.items()}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf, t)}.parquet'")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else 0.0 if isinstance(v, float) and v == 0 else v
    return sorted((tuple(clean(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, duck, sf, name):
    ours, theirs = QUERIES[name](spark, sf), duck.sql(ORACLE_SQL[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours.columns, [tuple(r) for r in ours.collect()]) == rows(theirs.columns, theirs.fetchall())


def test_resolve_cascade_gives_each_id_once(spark, sf):
    got = QUERIES["resolve_cascade"](spark, sf).collect()
    assert len({r["id"] for r in got}) == len(got) and all(r["entity"] and r["tier"] in ("tax", "name", "fuzzy", "minted") for r in got)


def test_all_offenders_of_a_check_are_listed(spark):
    sf = "/root/testdata/sf0.01"
    counted = {r["status"]: r["n"] for r in QUERIES["check_details"](spark, sf).collect()}
    listed = QUERIES["check_offenders"](spark, sf).collect()
    assert {s: sum(r["status"] == s for r in listed) for s in counted} == counted and max(counted.values()) > 20
    assert all(r["n"] == counted[r["status"]] for r in listed) and len({r["o_orderkey"] for r in listed}) == len(listed)
