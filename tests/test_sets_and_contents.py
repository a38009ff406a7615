"""Distinct counts that add up, checksums of content, means that don't depend on the order of rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.landing_data import ROWS, write_landing
from tidemark.operators.checksum import contents
from tidemark.operators.distinct import NUMBER, distinct_counts, distinct_sets, merged_sets, numbered
from tidemark.operators.geo import mean_point_per_key
from tidemark.plans import pipeline
from tidemark.plans.pipeline import Run
from tidemark.schemas import manifest
from tidemark.sources.bronze import ContentError, reconcile_contents


@pytest.fixture(scope="module")
def visits(spark):
    """40,000 persons, so that sets need several ranges; one state holds a third; NULLs in both."""
    rng = random.Random(4)
    state = {k: "A" if k % 3 == 0 else rng.choice(["B", "C", None]) for k in range(40_000)}
    rows = [(rng.randrange(1, 13), f"p{k}", state[k]) for k in (rng.randrange(40_000) for _ in range(90_000))]
    rows += [(1, None, "A"), (2, "p1", state[1]), (2, "p1", state[1])]
    return spark.createDataFrame(rows, "mes int, k string, uf string").repartition(8)


def test_numbers_are_dense_and_near(spark, visits):
    keys = numbered(visits, "k", near="uf", parts=16).join(visits.select("k", "uf").distinct(), "k").collect()
    assert sorted(r[NUMBER] for r in keys) == list(range(len(keys))) and len({r["k"] for r in keys}) == len(keys)
    by_state = defaultdict(list)
    for r in keys:
        by_state[r["uf"]].append(r[NUMBER])
    assert all(max(v) - min(v) + 1 == len(v) for v in by_state.values())
    again = numbered(visits.repartition(3), "k", near="uf", parts=16)
    assert {(r["k"], r[NUMBER]) for r in again.collect()} == {(r["k"], r[NUMBER]) for r in keys}
    assert numbered(visits.limit(0), "k").collect() == []


def test_counts_of_any_range_equal_plain_ones(spark, visits):
    rows = visits.join(numbered(visits, "k", near="uf"), "k", "left")
    sets = distinct_sets(rows, "mes", "uf").cache()
    plain = visits.collect()
    for first, last in ((1, 12), (3, 3), (2, 7)):
        some = sets.filter(F.col("mes").between(first, last))
        want = defaultdict(set)
        for r in plain:
            if r["k"] is not None and first <= r["mes"] <= last:
                want[r["uf"]].add(r["k"])
        got = {r["uf"]: r["distintos"] for r in distinct_counts(some, "uf").collect()}
        assert got == {s: len(v) for s, v in want.items()}
        assert distinct_counts(some).first()[0] == len(set().union(*want.values()))
    quarters = merged_sets(sets.withColumn("tri", F.expr("(mes + 2) div 3")), "tri", "uf")
    assert distinct_counts(quarters).first()[0] == distinct_counts(sets).first()[0]
    assert distinct_counts(sets.limit(0)).first()[0] == 0
    sets.unpersist()


def summed(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    return tuple(contents(df.repartition(3), ("a", "b")).first())


def test_a_checksum_tells_contents_apart(spark):
    rows = [("x", "y"), ("x", "y"), (None, "z"), ("", "z"), ("ab", "c")]
    same = summed(spark, rows)
    assert summed(spark, rows[::-1]) == same and same[0] == 5
    others = [
        rows[1:],
        [*rows, rows[0]],
        [("y", "x"), *rows[1:]],
        [("x", "y"), ("x", "y"), ("z", None), *rows[3:]],
        [*rows[:2], ("", "z"), ("", "z"), rows[4]],
        [*rows[:4], ("a", "bc")],
        [("q", "r"), ("q", "r"), *rows[2:]],  # the repeated row cancels out in the exclusive or
    ]
    assert all(summed(spark, other) != same for other in others)
    assert summed(spark, []) == (0, "0", 0)


def test_tables_that_are_missing_do_not_agree(spark):
    schema = "tabela string, linhas long, soma string, xor long"
    a = spark.createDataFrame([("t", 1, "5", 5), ("u", 1, "6", 6), ("v", 2, "7", 7)], schema)
    b = spark.createDataFrame([("t", 1, "5", 5), ("u", 1, "7", 6), ("w", 2, "7", 7)], schema)
    got = {r["tabela"]: (r["conta_bate"], r["conteudo_bate"]) for r in reconcile_contents(a, b).collect()}
    assert got == {"t": (True, True), "u": (True, False), "v": (False, False), "w": (False, False)}


def test_a_load_that_swaps_two_fields_stops(spark, tmp_path, monkeypatch):
    """Same count, same values, in each other's column."""
    real = pipeline.ingest_all_string

    def swapping(spark, path, schema=None, mode="whole"):
        rows = real(spark, path, schema, mode)
        if "sellers" in path:
            rows = rows.withColumns({"seller_city": F.col("seller_state"), "seller_state": F.col("seller_city")})
        return rows

    landing = write_landing(tmp_path / "landing")
    Run(spark, str(tmp_path / "good")).bronze(landing, manifest())
    monkeypatch.setattr(pipeline, "ingest_all_string", swapping)
    run = Run(spark, str(tmp_path / "bad"))
    with pytest.raises(ContentError, match="bronze: sellers$"):
        run.bronze(landing, manifest())
    assert run.rows["bronze.sellers"] == len(ROWS["sellers"])


def test_means_agree_to_the_last_digit(spark):
    rng = random.Random(8)
    points = [("z", str(rng.uniform(-33, 5)), f"{rng.uniform(-74, -34):.12f}") for _ in range(3000)]
    points += [("z", None, "n/a"), ("none", "x", None), ("big", "1e30", "NaN"), ("one", " -23.5 ", "0")]
    point = lambda n: F.col(n)
    seen = set()
    for parts in (1, 7, 23):
        df = spark.createDataFrame(points, "k string, lat string, lng string").repartition(parts)
        rows = mean_point_per_key(df, point("k"), point("lat"), point("lng"), F.lit("c"), F.lit("s")).collect()
        seen.add(tuple(sorted((r["cep_prefixo"], r["latitude"], r["longitude"], r["qtd_pontos_origem"]) for r in rows)))
        points.reverse()
    assert len(seen) == 1
    got = {r[0]: r[1:] for r in next(iter(seen))}
    lat = [float(p[1]) for p in points if p[0] == "z" and p[1]]
    assert got["z"][0] == pytest.approx(sum(lat) / len(lat), abs=1e-9) and got["z"][2] == 3001
    assert got["none"] == (None, None, 1) and got["big"] == (None, None, 1) and got["one"] == (-23.5, 0.0, 1)
