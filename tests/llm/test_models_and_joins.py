"""Toxicity, nearest neighbours, the Jaccard join and the pipeline."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import components, jaccard_tiles, posting_lists, toxicity_crf
from tests.llm.data import COLUMNS, awkward, documents, words


# toxicity


def plain_marginals(emit, first, model):
    out, cuts = [], [*np.flatnonzero(first).tolist(), len(emit)]
    for a, b in zip(cuts, cuts[1:]):
        forward, backward = np.zeros((b - a, 2)), np.ones((b - a, 2))
        for t in range(b - a):
            seen = np.array([1, np.exp(emit[a + t])])
            forward[t] = (forward[t - 1] @ model.trans if t else model.start) * seen
            forward[t] /= forward[t].sum()
        for t in range(b - a - 2, -1, -1):
            backward[t] = model.trans @ (np.array([1, np.exp(emit[a + t + 1])]) * backward[t + 1])
            backward[t] /= backward[t].sum()
        both = forward * backward
        out.append(both[:, 1] / both.sum(axis=1))
    return np.concatenate(out)


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 700])
def test_marginals_equal_the_plain_version(n):
    rng = np.random.default_rng(n)
    model = toxicity_crf.Model({}, 0.0, np.array([0.8, 0.2]), np.array([[2.0, 0.4], [0.5, 1.5]]), np.zeros(3))
    emit, first = rng.normal(0, 3, n), rng.random(n) < 0.03
    first[0] = True
    assert np.allclose(toxicity_crf.marginals(emit, first, model), plain_marginals(emit, first, model))


def toxic_table(spark, n=1200):
    rng = random.Random(6)
    rows, labels = awkward(), []
    for k in range(n):
        text, toxic = words(rng, rng.randrange(20, 60)), k % 5 == 0
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["Nastyone", "vileword,", "badterms"]))
        rows.append((10_000 + k, " ".join(text), "src1"))
        labels.append((10_000 + k, int(toxic), 1))
    labels += [(None, 1, 1), (10_000, None, 1), (999_999, 1, 0), (1000, 0, 0)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_toxic_words_are_learned(spark):
    docs, labels = toxic_table(spark)
    got = toxicity_crf.score_table(docs, labels).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    wrong = [r for r in got if r.predicted != bool(re.search("(?i)nastyone|vileword|badterms", texts[r.doc_id] or ""))]
    assert not wrong
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        found = {texts[r.doc_id][s.start : s.end].lower() for s in r.spans}
        assert (found != set()) == bool(r.predicted)
        assert all(re.search("nastyone|vileword|badterms", f) for f in found)
    assert {r.held_out for r in got} == {True, False}
    kept = toxicity_crf.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in got)


@pytest.mark.parametrize("others", [True, False])
def test_copies_of_one_toxic_document(spark, others):
    """A third of the rows; without other toxic documents nothing is left but that text's own words."""
    rng = random.Random(13)
    bad = ["nastyone", "vileword", "badterms"]
    hot = words(rng, 40) + bad + words(rng, 10)
    rows, labels = [], []
    for k in range(900):
        text, toxic = words(rng, rng.randrange(20, 60)), others and k % 10 == 0
        for _ in range(2 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        if k % 3 == 1:
            text, toxic = [w.upper() if k % 2 else w for w in hot], True
        rows.append((k, " ".join(text), "src1"))
        labels.append((k, int(toxic)))
    docs, labels = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    want = {r.doc_id for r in labels.collect() if r.toxic}
    got = toxicity_crf.score_table(docs, labels).collect()
    assert {r.doc_id for r in got if r.predicted} == want
    for r in got:
        found = {rows[r.doc_id][1][s.start : s.end].lower() for s in r.spans}
        assert all(b in " ".join(found) for b in bad) if r.doc_id % 3 == 1 else not others or bool(found) == (r.doc_id in want)
    kept = {r.doc_id for r in toxicity_crf.drop_toxic(docs, labels).collect()}
    assert kept == set(range(900)) - want


def test_spans_refer_to_the_text_itself():
    text = "\u0130stanbul \u0130 a NASTYONE, \u0130b VileWord Badterms end"
    words = toxicity_crf.words_of(text)
    assert words[3:] == ["nastyone", "i\u0307b", "vileword", "badterms", "end"]
    spans = toxicity_crf.spans_of(text, np.array([0.9 * (w in ("nastyone", "vileword", "badterms")) for w in words]))
    assert [text[s["start"] : s["end"]] for s in spans] == ["NASTYONE", "VileWord Badterms"]
    every = "x ".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c != 0x130)
    assert len(toxicity_crf.words_of(every)) == len(toxicity_crf.TOKEN.findall(every))


def test_held_out_accuracy(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity_crf.score_table(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.9


def test_without_labels(spark):
    docs = documents(spark, awkward())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity_crf.score_table(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity_crf.score_table(docs, one).collect()} <= {0.0, 1.0}
    assert toxicity_crf.score_table(spark.createDataFrame([], COLUMNS), one).collect() == []


# nearest neighbours


def plain_nearest(rows, k=20):
    good = {
        i: np.array(v, float) for i, v in rows
        if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v) and len(v) == 8
    }
    result = {}
    for q in good:
        if q % 20 == 0:
            scored = sorted(((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q))
            result[q] = [(i, -s) for s, i in scored[:k]]
    return result


def vectors(rng, n):
    rows = [(k, rng.normal(size=8).round(3).tolist()) for k in range(n)]
    rows += [(10_000 + k, rows[5][1]) for k in range(60)]  # ties
    rows += [(20_000, None), (20_020, [0.0] * 8), (20_040, [float("nan")] * 8), (None, [1.0] * 8), (20_060, [1.0])]
    return [*rows, rows[0]]


def test_small_tables_are_searched_exactly(spark):
    rows = vectors(np.random.default_rng(7), 300)
    got = posting_lists.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = plain_nearest(rows)
    found = {q: [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] for q in want}
    assert {r.query_id for r in got} == set(want)
    for q in want:
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_recall_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "LIST_ROWS", 60)
    monkeypatch.setattr(posting_lists, "PART_ROWS", 500)
    monkeypatch.setattr(posting_lists, "QUERY_ROWS", 40)
    rows = vectors(np.random.default_rng(8), 3000)
    got = posting_lists.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    rows = [(i, None if v is None else np.array(v, np.float32).tolist()) for i, v in rows]
    want = plain_nearest(rows)
    hits = {(r.query_id, r.vec_id) for r in got}
    assert sum((q, i) in hits for q in want for i, _ in want[q]) / sum(map(len, want.values())) > 0.9
    assert len(hits) == len(got)
    for q in want:
        ranks = sorted((r.rank, -r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r[0] for r in ranks] == list(range(1, 21)) and sorted(ranks, key=lambda r: (r[1], r[2])) == ranks


@pytest.mark.parametrize("groups", [1, 40])
def test_every_query_gets_its_rows_among_copies(spark, monkeypatch, groups):
    """Copies make centroids equal; those left empty move to single vectors and hold next to nothing."""
    monkeypatch.setattr(posting_lists, "LIST_ROWS", 20)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 16))
    for g in range(groups):
        x[2000 + g :: groups] = x[g]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = rng.permutation(3000)
    rows = [(int(i), v) for i, v in zip(ids, x.tolist())] + [(20, v) for v in rng.normal(size=(30, 16)).tolist()]
    got = posting_lists.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    returned = {q: sum(r.query_id == q for r in got) for q in range(0, 3000, 20)}
    assert set(returned.values()) == {20}
    scores = x[np.argsort(ids)] @ x[np.argsort(ids)].T
    hits = total = 0
    for q in range(40, 3000, 20):  # by score, as copies tie
        worst = np.sort(np.delete(scores[q], q))[-20]
        hits += sum(r.score >= worst - 1e-9 for r in got if r.query_id == q)
        total += 20
    assert hits / total > 0.9


def test_lists_are_added_until_they_hold_enough():
    centroids = np.array([[0.0], [1.0], [2.0], [3.0]])
    graph = np.array([[1, 2], [2, 3], [3, 0], [0, 1]])
    index = posting_lists.Index(centroids, graph, np.array([0]), 1.0, 1.5)
    lists = lambda held, enough, ratio=1.5: posting_lists.search_graph(index, np.zeros(1), ratio, held, enough)
    assert lists([9, 9, 9, 9], 9) == [0]
    assert lists([1, 9, 9, 9], 9) == [0, 1]
    assert lists([1, 2, 9, 9], 9) == [0, 1, 2, 3]  # the last one is within the ratio
    assert lists([1, 1, 1, 1], 9) == [0, 1, 2, 3]
    assert lists([9, 9, 9, 9], 9, float("inf")) == [0, 1, 2, 3]


def test_few_and_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert posting_lists.nearest(spark.createDataFrame([], kind)).collect() == []
    two = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.5, 2.0])], kind)
    assert [tuple(r) for r in posting_lists.nearest(two).collect()] == [(0, 1, 3, 0.5)]


# Jaccard join


def plain_groups(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = set()
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                parent[top(a)] = top(b)
                if x != y:
                    links.add((frozenset(x), frozenset(y)))
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[top(k)] = min(doc_id, ids.get(top(k), doc_id))
    return [(rows[k][0], len(sets[k]), ids.get(top(k))) for k in range(len(rows))], len({frozenset(p) for p in links})


def near_copies(rng):
    rows = []
    for _ in range(30):
        base = words(rng, rng.choice([2, 5, 12, 30, 80, 300]))
        for _ in range(rng.choice([1, 3, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
                k, r = rng.randrange(len(w)), rng.random()
                if r < 0.4:
                    w[k] = rng.choice(["New", "new", "other"])
                elif r < 0.7 and len(w) > 2:
                    del w[k]
                else:
                    w.insert(k, "more")
            rows.append((100_000 + len(rows), " ".join(w)))
    chain = words(rng, 120)
    for k in range(30):
        chain = [*chain[: k * 3], f"x{k}", *chain[k * 3 + 1 :]]
        rows.append((200_000 - k, " ".join(chain)))
    rng.shuffle(rows)
    return rows


def test_components_equal_the_plain_version(spark):
    rows = near_copies(random.Random(9)) + [(i, t) for i, t, _ in awkward()]
    docs = documents(spark, rows).repartition(5)
    want, links = plain_groups(rows)
    got = [tuple(r) for r in jaccard_tiles.component_table(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert jaccard_tiles.all_links(docs).count() == links > 100
    kept = jaccard_tiles.keep_one(docs)
    assert kept.columns == docs.columns
    found = [r.doc_id for r in kept.collect()]
    wordless = [i for i, t in rows if not (t or "").split()]
    groups = {c for _, n, c in want if n and c is not None}
    assert sorted(i for i in found if i is not None and i not in wordless) == sorted(groups)
    assert sorted(i for i in found if i in wordless) == sorted(wordless)


def test_tiles_and_bitmaps_never_lose_a_link(spark):
    rng = np.random.default_rng(10)
    bands, rows = jaccard_tiles.Bands(), []
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**63, rng.integers(10, 400)).astype(np.uint64) * np.uint64(2))
        keep = rng.random(len(x)) > rng.random() * 0.12
        y = np.unique(np.concatenate([x[keep], rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if both >= jaccard_tiles.needed(len(x), len(y)) and not both == len(x) == len(y):
            tiles = [{t: (set(names.tolist()), bits) for t, names, bits in jaccard_tiles.signatures(z, bands)} for z in (x, y)]
            shared = [t for t in tiles[0] if t in tiles[1] and tiles[0][t][0] & tiles[1][t][0]]
            assert shared
            for t in shared:
                maps = [tile[t][1] for tile in tiles]
                ones = [sum(int(b).bit_count() if b >= 0 else 64 - int(~b).bit_count() for b in m) for m in maps]
                rows.append((len(x), ones[0], maps[0].tolist(), len(y), ones[1], maps[1].tolist()))
    kind = "a_n long, a_ones int, a_bits array<long>, b_n long, b_ones int, b_bits array<long>"
    table = spark.createDataFrame(rows, kind)
    assert len(rows) > 100 and table.filter(jaccard_tiles.may_link("a_", "b_")).count() == len(rows)


def test_no_documents(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert jaccard_tiles.component_table(empty).collect() == []
    assert jaccard_tiles.keep_one(empty).collect() == []


def test_components_of_paths_and_stars(spark):
    rng = random.Random(11)
    names = [rng.getrandbits(63) - 2**62 for _ in range(300)]
    links = [(names[k], names[k + 1]) for k in range(99)] + [(names[100], names[k]) for k in range(101, 200)] + [(5, 5)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.component, set()).add(r.vertex)
    assert sorted(map(sorted, groups.values())) == sorted([sorted(names[:100]), sorted(names[100:200])])
    assert all(c in members for c, members in groups.items())


# pipeline


def test_pipeline_equals_its_operators(spark, sf_dir):
    """Each stage alone on what the one before kept, against plain versions where there are some."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in toxicity_crf.score_table(docs, labels).collect()}
    stages = [f for _, f in corpus_pipeline.STAGES]
    clean = stages[0](spark, docs, sf_dir)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, p in scores.items() if not p)
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    single = stages[1](spark, clean, sf_dir)
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in plain_groups(rows)[0]})
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    free = stages[2](spark, single, sf_dir)
    holds = lambda t: any(i in " ".join(re.findall(r"\w+", t.lower())) for i in items)
    assert sorted(r.doc_id for r in free.collect()) == sorted(r.doc_id for r in single.collect() if not holds(r.text))
    mixed = stages[3](spark, free, sf_dir)
    assert mixed.columns == docs.columns
    total = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert total(mixed) == pytest.approx(total(free), rel=0.1)
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in free.collect()}
    last = corpus_pipeline.run(spark, sf_dir)
    key = lambda r: (r.doc_id, r.text)
    assert sorted(map(key, last.collect())) == sorted(map(key, mixed.collect()))
    shards = {r.shard for r in last.select("shard").collect()}
    assert shards <= set(range(40)) and len(shards) > 35  # about three rows for a shard, some of them large
