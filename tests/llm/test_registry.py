"""Registered queries against their SQL, and every operator has one."""

import duckdb
import pytest

from hourglass.llm.oracles import ORACLES
from hourglass.llm.queries import QUERIES


def test_each_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == [*range(1, 14)]
    import __spark_entry__

    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_oracle(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    # plain Python values: a missing one is None on both sides
    in_order = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    assert in_order(got.collect()) == in_order(want)
