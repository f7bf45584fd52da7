import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, values
from tidemark.operators import similarity, textvec
from tidemark.session import durable


def brute_force(data, k):
    """Neighbours of each id by comparing all pairs."""
    def cosine(a, b):
        la, lb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        return sum(x * y for x, y in zip(a, b)) / (la * lb) if la and lb else 0.0

    out = {}
    for i, u in data:
        ranked = sorted((-round(cosine(u, v), 10), j) for j, v in data if j != i)[:k]
        out[i] = [j for _, j in ranked]
    return out


def clustered(seed, n, dims=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(int(i), [float(x) for x in centres[i % 6] + rng.normal(scale=0.3, size=dims)]) for i in range(n)]


@pytest.mark.parametrize("pivots, block", [(1, 1000), (5, 10), (12, 7)])
def test_neighbours_equal_brute_force(spark, pivots, block):
    data = clustered(1, 90)
    data += [(1000 + i, [0.0] * 8) for i in range(3)]      # zero vectors
    data += [(2000 + i, data[4][1]) for i in range(40)]    # a hot group of copies
    data += [(3000, [-x for x in data[5][1]])]
    df = spark.createDataFrame(data, "id BIGINT, v ARRAY<DOUBLE>")
    got = similarity.nearest_neighbours(df, "id", "v", 3, pivots, block)
    near = {}
    for r in got.orderBy("id", "rank").collect():
        near.setdefault(r.id, []).append(r.neighbour)
    assert near == brute_force(data, 3)


def test_few_rows(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0])], "id STRING, v ARRAY<DOUBLE>")
    assert values(similarity.nearest_neighbours(df, "id", "v", 3), "id", "neighbour") == [("a", "b"), ("b", "a")]
    assert similarity.nearest_neighbours(df.limit(0), "id", "v", 3).isEmpty()
    zeros = spark.createDataFrame([(i, [0.0]) for i in range(5)], "id INT, v ARRAY<DOUBLE>")
    text = similarity.neighbour_text(similarity.nearest_neighbours(zeros, "id", "v", 2), "id")
    assert values(text)[:2] == [(0, "1, 2"), (1, "0, 2")]


def test_null_vectors_are_no_neighbours(spark):
    data = [(0, None), (1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [None, 1.0]), (4, [0.0, 0.0])]
    df = spark.createDataFrame(data, "id INT, v ARRAY<DOUBLE>")
    got = values(similarity.nearest_neighbours(df, "id", "v", 3), "id", "neighbour")
    assert got == [(1, 2), (1, 4), (2, 1), (2, 4), (4, 1), (4, 2)]
    nulls = df.filter("id IN (0, 3)")
    assert similarity.nearest_neighbours(nulls, "id", "v", 3).isEmpty()
    one = similarity.nearest_neighbours(nulls.union(df.filter("id = 4")), "id", "v", 3)
    assert one.isEmpty()


def test_no_cross_join(spark):
    df = spark.createDataFrame(clustered(2, 60), "id BIGINT, v ARRAY<DOUBLE>")
    text = plan(similarity.nearest_neighbours(df, "id", "v", 3, 4, 10))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_matrices_are_not_shuffled(spark, monkeypatch):
    df = spark.createDataFrame(clustered(2, 60), "id BIGINT, v ARRAY<DOUBLE>")
    plans = {}

    def watched(step, label="step", *more):
        plans[label] = plan(step)
        return durable(step, label, *more)

    monkeypatch.setattr(similarity, "durable", watched)
    similarity.nearest_neighbours(df, "id", "v", 3, 4, 10)
    assert "Exchange" not in plans["hits"]


def two_languages(seed, n, dims=40):
    """Sparse vectors, most of them of one half of the components or of the other."""
    rng = np.random.default_rng(seed)
    units = rng.random((n, dims)) * (rng.random((n, dims)) < 0.4)
    units[: n // 2, dims // 2 :] *= rng.random((n // 2, 1)) < 0.05
    units[n // 2 :, : dims // 2] *= rng.random((n - n // 2, 1)) < 0.05
    return units


@pytest.mark.parametrize("least_rest, few", [(0.02, 64), (0.6, 64), (0.6, 1)])
def test_bounds_leave_nothing_out(monkeypatch, least_rest, few):
    """Blocks compared by some components find the same as all pairs in full."""
    monkeypatch.setattr(similarity, "_REST", least_rest)
    monkeypatch.setattr(similarity, "_FEW", few)
    units = two_languages(5, 240)
    units = units[units.any(axis=1)]
    units /= np.linalg.norm(units, axis=1)[:, None]
    full = np.round(units @ units.T, 10)
    cut, compared = [], similarity._components
    monkeypatch.setattr(similarity, "_components", lambda a, b: cut.append(compared(a, b)) or cut[-1])
    packs = []
    for rows in (np.arange(0, 120), np.arange(120, len(units))):
        query, at = np.nonzero(units[rows])
        counts = np.bincount(query, minlength=len(rows))
        held = similarity._Vectors.of(counts, at.astype(similarity._AT), units[rows][query, at], 40)
        pack = similarity._Pack(rows.tolist(), [50, len(rows) - 50], held)
        pack.blocks, pack.cells, pack.visits = list(pack.blocks), [{0}, {0}], [{0}, {0}]
        best = similarity._within(pack, 4, 10)
        assert np.allclose(best.score, -np.sort(-full[np.ix_(rows, rows)], axis=1)[:, :4], atol=2e-10)
        pack.floor = best.score[:, -1]
        for (first, last), part in zip(pack.ranges, pack.blocks):
            part.asks(pack.floor[first:last])
        packs.append((rows, pack))
    (one, a), (two, b) = packs
    for rows, others, pack, best in zip((one, two), (two, one), (a, b), similarity._between(a, b, 4, 10)):
        want = -np.sort(-full[np.ix_(rows, others)], axis=1)[:, :4]
        want = np.where(want >= pack.floor[:, None], want, -np.inf)
        assert np.allclose(best.score, want, atol=2e-10)
    assert any(c is not None and len(c) < 40 for c in cut)


def test_each_two_packs_meet_once(spark, monkeypatch):
    """No pair of blocks is compared from both sides, and binaries hold what is not zero only."""
    sizes = {}

    def watched(step, label="step", *more):
        out = durable(step, label, *more)
        if label == "packs":
            sizes[label] = out.selectExpr("size(gids) AS n", "length(w) AS w").collect()
        if label == "hits":
            sizes[label] = out.count()
        return out

    monkeypatch.setattr(similarity, "durable", watched)
    units = two_languages(6, 300)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(units)]
    df = spark.createDataFrame(data, "id BIGINT, v ARRAY<DOUBLE>")
    near = {}
    for r in similarity.nearest_neighbours(df, "id", "v", 3, 6, 20).orderBy("id", "rank").collect():
        near.setdefault(r.id, []).append(r.neighbour)
    assert near == brute_force(data, 3)
    packs = sizes["packs"]
    assert len(packs) > 3 and sum(r.w for r in packs) == 8 * np.count_nonzero(units)
    assert sizes["hits"] < 4 * 300 * len(packs) / 2


def test_many_equal_scores(spark):
    data = [(i, [float(i == j) for j in range(150)]) for i in range(150)]  # all at right angles
    data += [(200 + i, [1.0, 1.0, 1.0 + i / 9] + [0.0] * 147) for i in range(30)]
    df = spark.createDataFrame(data, "id BIGINT, v ARRAY<DOUBLE>")
    near = {}
    for r in similarity.nearest_neighbours(df, "id", "v", 3, 3, 100).orderBy("id", "rank").collect():
        near.setdefault(r.id, []).append(r.neighbour)
    assert near == brute_force(data, 3)


DOCS = [(0, "The cat and the cat sat"), (1, "a dog sat; DOG barks"), (2, "Émile's café, 42 cats"), (3, ""), (4, None),
        (5, "cat " * 30 + "dog")]


def expected_vectors(max_features, stop):
    import re

    docs = {i: [w for w in re.findall(r"\b\w\w+\b", (t or "").lower()) if w not in stop] for i, t in DOCS}
    total, df = Counter(), Counter()
    for words in docs.values():
        total.update(words)
        df.update(set(words))
    terms = sorted(sorted(total, key=lambda w: (-total[w], w))[:max_features])
    idf = {w: math.log((1 + len(DOCS)) / (1 + df[w])) + 1 for w in terms}
    out = {}
    for i, words in docs.items():
        v = [words.count(w) * idf[w] for w in terms]
        n = math.sqrt(sum(x * x for x in v))
        out[i] = [x / n if n else 0.0 for x in v]
    return terms, out


@pytest.mark.parametrize("size", [3, 100])
def test_tfidf(spark, size):
    df = spark.createDataFrame(DOCS, "id INT, t STRING")
    vocab = textvec.fit_vocabulary(df, "t", size, ["the", "and"])
    terms, want = expected_vectors(size, {"the", "and"})
    assert list(vocab.terms) == terms
    sparse = vocab.sparse(F.col("t"))
    got = {r.id: r.v for r in df.select("id", vocab.dense(sparse).alias("v")).collect()}
    for i, v in want.items():
        assert got[i] == pytest.approx(v, abs=1e-12)
    query = vocab.embed(spark, "cat DOG unknown")
    found = similarity.search(df, "id", textvec.sparse_score(sparse, query), 10)
    scores = {i: sum(a * b for a, b in zip(v, query)) for i, v in want.items()}
    assert [r.id for r in found.collect()] == sorted(scores, key=lambda i: (-round(scores[i], 4), i))


def test_default_stop_words(spark):
    df = spark.createDataFrame(DOCS, "id INT, t STRING")
    assert "the" not in textvec.fit_vocabulary(df, "t").terms


def test_hybrid(spark):
    df = spark.createDataFrame([(1, "x", [1.0, 0.0]), (2, "y", [1.0, 0.1]), (3, "x", [0.0, 1.0])],
                               "id INT, g STRING, v ARRAY<DOUBLE>")
    from tidemark.functions.vectors import cosine_to

    score = cosine_to(F.col("v"), [1.0, 0.0])
    got = similarity.hybrid_search(df, "id", score, equals={"g": "x"}, at_least={"id": None})
    assert [(r.id, r.similarity_score) for r in got.collect()] == [(1, 1.0), (3, 0.0)]
    assert [r.id for r in similarity.hybrid_search(df, "id", None, at_most={"id": 2}).collect()] == [1, 2]


def test_approximate_neighbours(spark):
    data = clustered(3, 500) + [(9000 + i, [1.0] * 8) for i in range(250)]  # a third has one vector
    data += [(9900, [0.0] * 8), (9901, None), (9902, [None] * 8)]
    df = spark.createDataFrame(data, "id BIGINT, v ARRAY<DOUBLE>").repartition(5)
    found = durable(similarity.nearest_approximate(df, "id", "v", 3, tables=6, block=64))
    assert similarity.recall(found, similarity.nearest_neighbours(df.filter("id < 9900"), "id", "v", 3), "id").first().recall >= 0.9
    rows = found.collect()
    assert len(rows) == 3 * 750 and all(r.vec_rank in (1, 2, 3) for r in found.selectExpr("rank AS vec_rank").collect())
    vector = {i: np.array(v) for i, v in data if i < 9900}
    for r in rows:
        a, b = vector[r.id], vector[r.neighbour]
        assert r.id != r.neighbour and abs(a @ b / np.linalg.norm(a) / np.linalg.norm(b) - r.score) < 1e-9


def test_approximate_neighbours_of_few_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], "id BIGINT, v ARRAY<DOUBLE>")
    got = similarity.nearest_approximate(df, "id", "v", 3)
    assert values(got, "id", "rank", "neighbour") == [(1, 1, 2), (2, 1, 1)]
    assert similarity.nearest_approximate(df.limit(1), "id", "v", 3).count() == 0
    none = similarity.nearest_approximate(df.limit(0), "id", "v", 3)
    assert none.count() == 0
    assert tuple(similarity.recall(none, none, "id").first()) == (0, 0, None)


def test_approximate_neighbours_sort_codes_without_vectors(spark, monkeypatch):
    data = clustered(4, 300) + [(5, [2.0] * 8), (5, [2.0] * 7 + [1.0])]  # a key that repeats
    df = spark.createDataFrame(data, "id BIGINT, v ARRAY<DOUBLE>")
    sorted_, number = [], similarity.number_rows

    def watched(rows, *more, **named):
        sorted_.append(rows.columns)
        return number(rows, *more, **named)

    monkeypatch.setattr(similarity, "number_rows", watched)
    found = similarity.nearest_approximate(df, "id", "v", 3, block=64)
    assert found.groupBy("id").count().filter("count <> 3").isEmpty()
    assert sorted_ and not any("u" in columns for columns in sorted_)
