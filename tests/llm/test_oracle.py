"""Registered queries of the subpackage against their SQL, and those without SQL for rows and types."""

from __future__ import annotations

import pytest
from compare import compare, duck

from ledgerloom.llm import queries

PATH = "/root/testdata/sf0.001"
SOURCE = {"op2_html_extraction": "pages", "op3_nearest_neighbours": None}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, PATH)
    rows = [tuple(r) for r in df.collect()]
    con = duck(PATH)
    if name in queries.ORACLE:
        cur = con.execute(queries.ORACLE[name])
        cols = [d[0] for d in cur.description]
        assert compare(rows, df.columns, cur.fetchall(), cols) is None
    elif SOURCE.get(name, "documents"):
        given = con.execute(f"select count(*) from {SOURCE.get(name, 'documents')}").fetchone()[0]
        assert len(rows) == given
