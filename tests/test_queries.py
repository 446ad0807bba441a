"""Every registered engine query against its DuckDB SQL on the smallest tables; plans that should not move data."""

import os

import duckdb
import pytest

from ripplebook import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    show = lambda v: repr(round(v, 9)) if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[k]) for k in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got.columns, map(tuple, got.collect())) == canon(want.columns, want.fetchall())


def test_depth_features_move_nothing_beyond_the_books(spark, capsys):
    from ripplebook.adapters import books
    from ripplebook.operators import facts, features

    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    books(spark, SF).write.mode("overwrite").format("noop").save()
    features.depth_feature(facts.book_facts(spark.range(1).selectExpr("'s' symbol", "'c' condition_id", "'a' asset_id", "'o' outcome", "id local_recv_ts_ns", "id ingest_seq", "array(struct(1D as price, 1D as size)) bids", "array(struct(1D as price, 1D as size)) asks"))).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan
