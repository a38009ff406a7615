"""The registered queries: SQL oracles, and the contracts' shapes on whole tables."""

from pathlib import Path

import duckdb
import numpy as np
import pytest

from tidemark.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{Path(sf_dir) / table}.parquet')")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    got = [tuple(r[c] for c in columns) for r in QUERIES[name](spark, sf_dir).collect()]
    assert want and sorted(got) == sorted(want)


def test_search_reaches_its_recall(spark, sf_dir):
    got = QUERIES["op8_posting_lists"](spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in table])
    vectors = np.array([r.embedding for r in table], float)
    found = {(r.query_id, r.vec_id) for r in got}
    hits = total = 0
    for k in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[k]).sum(axis=1)
        scores[k] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        hits += sum((ids[k], i) in found for i in best)
        total += len(best)
    assert len(got) == total and hits / total >= 0.9


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
