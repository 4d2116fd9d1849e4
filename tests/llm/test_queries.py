"""The queries with SQL, against it, on the smallest tables."""

from pathlib import Path

import pytest

from revlake.llm import queries

SF = "/root/testdata/sf0.001"


def plain(x):
    return None if x is None or x != x else round(float(x), 5) if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    got = queries.queries()[name](spark, SF)
    cursor = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    rows = lambda data: sorted((tuple(plain(x) for x in r) for r in data), key=str)
    assert rows(map(tuple, got.select(*columns).collect())) == rows(cursor.fetchall())
