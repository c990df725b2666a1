"""The queries that SQL can express, against their SQL: on a driver's table and on odd and empty ones."""

import duckdb
import pytest

from lakemill.llm import queries


@pytest.mark.parametrize("folder", ("sf", "odd_dir", "empty_dir"))
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, request, folder, name):
    d = request.getfixturevalue(folder)
    duck = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        path = f"{d}/{t}.parquet" if folder == "sf" else f"{d}/{t}.parquet/*.parquet"
        # ids that are null or repeated make a text ambiguous for a join by id
        sound = " QUALIFY count(*) OVER (PARTITION BY doc_id) = 1 AND doc_id IS NOT NULL" if t == "documents" and name != "op13_phrases" else ""
        duck.sql(f"CREATE TABLE {t} AS SELECT * FROM '{path}'{sound}")
    ids = {r[0] for r in duck.sql("SELECT doc_id FROM documents").fetchall()}
    want = duck.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, d)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r[c] for c in want.columns) for r in got.collect()]
    if name not in ("op3_chat", "op13_phrases"):
        rows = [r for r in rows if r[0] in ids]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)
