"""Every registered query against its DuckDB statement, on the smallest tables."""

import datetime as dt
import decimal
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        raise AssertionError("results hand decimals out as DOUBLE")
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(entry_points.QUERIES) <= set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert mine == theirs


def test_provenance_sees_a_change_in_any_file(spark, tmp_path):
    from freightlens.sources.files import provenance

    rows = spark.createDataFrame([(i, f"n{i}", i / 4) for i in range(20)], "k int, n string, x double")
    read = lambda: spark.read.schema(rows.schema).parquet(f"{tmp_path}/a", f"{tmp_path}/b")
    rows.filter("k < 10").write.parquet(f"{tmp_path}/a")
    rows.filter("k >= 10").write.parquet(f"{tmp_path}/b")
    first = provenance("s", read()).first()
    assert first == provenance("s", rows.repartition(3)).first() and first["row_count"] == 20
    rows.filter("k >= 10").withColumn("x", rows["x"] + 1).write.mode("overwrite").parquet(f"{tmp_path}/b")
    assert provenance("s", read()).first()["content_sum"] != first["content_sum"]


def test_entry_runs(spark):
    statuses = {r["audit_status"] for r in entry_points.entry(spark).collect()}
    assert "MATCHED" in statuses
