"""Queries over tables with nulls in their keys, against their SQL."""

import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def nulled(tmp_path_factory):
    """The given tables with nulls in some columns of lineitem."""
    d, con = str(tmp_path_factory.mktemp("nulled")), duckdb.connect()
    some = {"l_orderkey": 503, "l_partkey": 97, "l_suppkey": 89, "l_linenumber": 11, "l_quantity": 83, "l_discount": 79, "l_returnflag": 73, "l_shipdate": 211}
    cols = ", ".join(f"CASE WHEN i % {n} = {k} THEN NULL ELSE {c} END AS {c}" for k, (c, n) in enumerate(some.items()))
    con.execute(f"COPY (SELECT {cols}, l_extendedprice, l_tax, l_linestatus FROM (SELECT *, row_number() OVER () AS i FROM '{SF}/lineitem.parquet')) TO '{d}/lineitem.parquet' (FORMAT parquet)")
    for t in ("region", "nation", "orders"):
        os.symlink(f"{SF}/{t}.parquet", f"{d}/{t}.parquet")
    return d


def rows(spark, name, d):
    return sorted((tuple(None if x is None else str(x) for x in r) for r in __spark_entry__.queries()[name](spark, d).collect()), key=repr)


def test_rebuild_keeps_participants_without_keys(spark, nulled):
    assert rows(spark, "conversation_rebuild", nulled) == rows(spark, "conversation_rollup", nulled)


@pytest.mark.parametrize("name", ["conversation_rebuild", "vendor_by_country", "vendor_by_continent"])
def test_nulls_as_in_sql(spark, nulled, name):
    con = duckdb.connect()
    for t in ("region", "nation", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{nulled}/{t}.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()[name]).fetchall()
    assert rows(spark, name, nulled) == sorted((tuple(None if x is None else str(x) for x in r) for r in want), key=repr)
