"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from gablework.plans import areas, registry  # noqa: F401 - areas registers its queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order)) for r in records)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA)
    records = [tuple(r) for r in got.collect()]
    if name in registry.oracle_sql():
        want = duck.execute(registry.oracle_sql()[name])
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(got.columns)
        assert rows(got.columns, records) == rows(columns, want.fetchall())
    else:
        assert records


def test_homography_error_is_none(spark):
    assert registry.queries()["homography_from_points"](spark, DATA).where("error > 1e-6").count() == 0
