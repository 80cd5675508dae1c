"""Every registered query against its DuckDB SQL at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, duck

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_pair(spark, con, name):
    ok, msg = compare(spark, name, queries()[name], oracle_sql()[name], SF01, con)
    assert ok, msg


def test_every_query_has_an_oracle():
    from wordfold.plans.queries import ORACLE_SQL, QUERIES

    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert [f.simpleString() for f in df.schema.fields] == ["n:bigint", "word:string"]
    rows = df.collect()
    assert 0 < len(rows) <= 100


def test_every_query_has_a_stable_schema(spark):
    from wordfold.plans.queries import QUERIES

    for name, q in QUERIES.items():
        if name in ("report_roundtrip", "file_lines", "file_top_words_report"):
            continue  # these write files on call; covered by their oracle pairs
        assert q(spark, SF01).schema == q(spark, SF01).schema, name
