"""Decontamination, source divergence and whitening against brute force, and on awkward tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import SMALL, awkward, empty
from tidemark.llm import lanczos_whitening, source_divergence, suffix_automaton
from tidemark.llm.suffix_automaton import Automaton
from tidemark.llm.workload import QUERIES

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(text):
    return (text or "").translate(ASCII_LOWER)


# suffix automaton


def hits(text, items, window):
    """Words inside occurrences of windows, and the items that have them, place by place."""
    hit, seen = set(), set()
    for name, item in items:
        size = min(window, len(item))
        for i in range(len(item) - size + 1 if item else 0):
            for j in range(len(text) - size + 1):
                if text[j : j + size] == item[i : i + size]:
                    hit |= set(range(j, j + size))
                    seen.add(name)
    return hit, seen


def test_automaton_finds_every_window():
    rng = random.Random(5)
    for _ in range(800):
        window, letters = rng.choice([2, 3, 4]), rng.randint(1, 4)
        items = {}
        for i in range(rng.randint(0, 6)):
            item = b" ".join(bytes([97 + rng.randrange(letters)]) for _ in range(rng.randint(1, 9)))
            items.setdefault(item, []).append(str(i))
        text = [bytes([97 + rng.randrange(letters + 1)]) for _ in range(rng.randint(0, 25))]
        spans, seen = Automaton(items, window).scan(text)
        pairs = [(name, item.split(b" ")) for item, names in items.items() for name in names]
        assert ({x for a, b in spans for x in range(a, b)}, seen) == hits(text, pairs, window)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string")


LINE = "one two three four five six seven eight nine ten eleven twelve"


@pytest.mark.parametrize("block", [suffix_automaton.BLOCK_WORDS, 7])
def test_matches_are_the_same_in_blocks(spark, monkeypatch, block):
    """Small blocks and pieces, several passes: the rows of one pass."""
    monkeypatch.setattr(suffix_automaton, "BLOCK_WORDS", block)
    monkeypatch.setattr(suffix_automaton, "PIECE_WORDS", 12 if block == 7 else 10_000)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(4)]
    items = [(str(i), " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(12)]
    items += [(None, "w0 w1 w2 w3 w0 w0 w0 w3 w3 w3 w1"), ("x", None), ("y", " - "), items[0]]
    texts = [(i, " ".join(rng.choices(words, k=rng.randint(0, 200)))) for i in range(30)]
    texts += [(i, f"{items[i % 12][1].upper()}! {t}") for i, t in texts]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = suffix_automaton.matched(docs, bench(spark, items), words=8).collect()
    pairs = [(name, ITEM_WORD.findall(lowered(item))) for name, item in items]
    wanted = sorted((i, *hits(ITEM_WORD.findall(lowered(t)), pairs, 8)) for i, t in texts)
    got = sorted((r.doc_id, {x for s in r.spans for x in range(s.start, s.end)}, r["items"], r.n_hit) for r in found)
    for (i, hit, seen), (j, spans, names, n) in zip(
        sorted(wanted, key=lambda r: (r[0], sorted(r[1]))), sorted(got, key=lambda r: (r[0], sorted(r[1])))
    ):
        assert (i, hit, sorted(seen - {None}), len(hit)) == (j, spans, names, n)


def test_spans_are_removed(spark):
    docs = spark.createDataFrame(
        [(1, f"Before, é! {LINE.upper()}. After the span there are some more words to keep here, ok?"), (2, LINE), (3, None), (4, "")],
        "doc_id long, text string",
    )
    out = {r.doc_id: r.text for r in suffix_automaton.cleaned(docs, bench(spark, [("a", LINE)])).collect()}
    assert out == {1: "Before, é! . After the span there are some more words to keep here, ok?", 3: None, 4: ""}
    kept = suffix_automaton.cleaned(docs, bench(spark, [("a", LINE)]), most_covered=1.0)
    assert kept.filter("doc_id = 2").first().text == ""
    # a span at the limit of ten words goes, one of nine stays
    nine = spark.createDataFrame([(1, LINE.rsplit(" ", 3)[0]), (2, LINE.rsplit(" ", 2)[0])], "doc_id long, text string")
    assert [r.n_hit for r in suffix_automaton.matched(nine, bench(spark, [("a", LINE)])).orderBy("doc_id").collect()] == [0, 10]


def test_decontamination_awkward(spark):
    docs = awkward(spark)
    items = bench(spark, [("k", "a b c d e f"), ("l", "lorem ipsum dolor"), (None, "x")])
    out = suffix_automaton.matched(docs, items)
    assert out.count() == 13 and set(docs.columns) <= set(out.columns)
    by = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by[0].n_words == by[1].n_words == by[2].n_words == 0 and not by[0].spans
    assert by[3]["items"] == ["l"] and by[3].n_hit == 18000 and by[3].n_words == 36000
    assert by[6]["items"] == ["k"] and by[6].n_hit == 6
    assert by[8]["items"] == [] and by[8].n_hit == 1
    assert suffix_automaton.matched(empty(spark), items).count() == 0
    nothing = suffix_automaton.matched(docs, bench(spark, []))
    assert nothing.agg(F.sum("n_hit")).first()[0] == 0
    clash = docs.withColumnRenamed("score", "spans").withColumnRenamed("kept", "items").withColumnRenamed("text", "n_hit")
    clashed = suffix_automaton.matched(clash, items, text="n_hit")
    assert clashed.agg(F.sum("n_hit")).first()[0] == out.agg(F.sum("n_hit")).first()[0]
    assert suffix_automaton.cleaned(docs, items).columns == docs.columns


def test_decontamination_digest(spark):
    items = bench(spark, [("10", LINE), ("9", LINE + " more"), ("x", "zz")])
    docs = spark.createDataFrame([(1, "say " + LINE), (2, "none")], "doc_id long, text string")
    rows = {r.doc_id: r for r in suffix_automaton.digests(docs, items).collect()}
    assert rows[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest() and rows[1].n_items == 2 and rows[1].contaminated
    assert rows[2].items_sha256 == hashlib.sha256(b"").hexdigest() and not rows[2].contaminated


# source divergence


def audit(rows, least=10, best=10):
    """The audit with Python's whole numbers."""
    df, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall(lowered(text))
        df[lang].update(set(terms))
        count[lang, source].update(terms)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        sources = sorted(s for x, s in groups if x == lang)
        v = len(kept)

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: share(count[lang, s]) for s in sources}
        whole = share(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [
                (-((p[s][t] - whole[t]) ** 2 // (p[s][t] + whole[t])), t.encode(), t)
                for t in kept
                if count[lang, s][t] and p[s][t] > whole[t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:best])):
                out |= {(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(found)}
    return out


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def audited(df, **options):
    return {tuple(r[c] for c in COLUMNS) for r in source_divergence.audited(df, **options).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_audit(spark, monkeypatch, small):
    """Whole numbers throughout, also with shards, tiles, blocks and slices of a few rows."""
    if small:
        for name, value in {"SHARD_ROWS": 100, "TILE": 2, "CELLS": 64, "SLICE_BYTES": 2000, "HELD_ROWS": 50}.items():
            monkeypatch.setattr(source_divergence, name, value)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id % 3 = 0 or source = 'src1'")
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert audited(docs) == audit(rows)


def test_audit_awkward(spark):
    rows = [("x", s, t) for s, t in (("b", "A a É é 3a"), ("ß", "a a"), (None, ""), ("b", None), ("c", "\x00"))]
    rows += [(None, "b", "a"), (None, None, None), ("z", "only", "!"), ("x", "hot", "word " * 50_000)] + [("x", "hot", "a b c")] * 40
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    clash = docs.withColumns({c: F.lit("t") for c in ("item", "value", "rank", "part", "n", "df", "term", "shard")})
    for least in (1, 2, 10):
        assert audited(clash, least_documents=least) == audit(rows, least)
    assert audited(docs.limit(0)) == set()


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(2000):
        whole, terms = rng.randrange(1, 9 * 10**13 - 10**9), rng.randrange(1, 10**8)
        count = rng.randrange(0, whole)
        got = source_divergence.shares(np.array([count]), np.array([whole]), terms)[0]
        assert got == 1 + 10**9 * (count + 2) // (whole + 2 * terms)


# whitening


def plain_whitening(rows):
    x = np.floor(64 * np.array(rows, "f8")).astype("i8") + 1_000_000
    n, s = len(x), x.sum(0)
    centred = x - s / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    return x, n, s, centred, e[::-1], v[:, ::-1], np.trace(cov)


def test_whitening(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    x, n, s, centred, e, v, trace = plain_whitening([r.embedding for r in rows])
    wanted = centred @ v[:, :32] / np.sqrt(e[:32])
    got = QUERIES["op13_lanczos_whitening"](spark, SMALL).orderBy("vec_id", "component").collect()
    assert len(got) == 32 * n and {r.component for r in got} == set(range(1, 33))
    y = np.array([r.whitened for r in got]).reshape(n, 32)
    assert np.abs(y * np.sign((y * wanted).sum(0)) - wanted).max() < 1e-9
    assert np.allclose([r.explained for r in got[:32]], e[:32] / trace, rtol=1e-12)
    assert [r.deviation for r in got[::32]] == ((n * x - s) ** 2).sum(1).tolist()
    assert {r.n for r in got} == {n} and got[0].identity_error < 1e-12


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, deviation long, n long")


def test_whitening_awkward(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.normal(size=4)]) for i in range(30)]
    good += [(99, good[0][1])] * 60 + [(None, good[1][1])]  # repeated rows hold most of the table
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [math.nan, 0.0, 0.0, 0.0]), (203, [math.inf] * 4), (204, []), (205, [1.0] * 3), (206, [1e30] * 4)]
    table = vectors(spark, [(i, v, "w", 5, 6) for i, v in good + bad])
    out = lanczos_whitening.component_rows(table).collect()
    x, n, s, centred, e, v, trace = plain_whitening([v for _, v in good])
    assert len(out) == 4 * len(good) and {r.n for r in out} == {len(good)} and {r.vec_id for r in out}.isdisjoint(range(200, 207))
    whole = lanczos_whitening.whitened(table, lanczos_whitening.fit(table))
    assert set(whole.columns) == set(table.columns) and whole.count() == len(good)
    deviations = Counter(r.deviation for r in out)
    assert deviations == Counter({d: 4 * k for d, k in Counter(((n * x - s) ** 2).sum(1).tolist()).items()})
    for none in (vectors(spark, []), vectors(spark, [(1, [1.0, 2.0], "", 0, 0)]), vectors(spark, [(1, None, "", 0, 0)])):
        assert lanczos_whitening.component_rows(none).collect() == []


@pytest.mark.parametrize("spread", [[1.0] * 6, [9.0, 9.0, 9.0, 4.0, 4.0, 1.0], [5.0, 1.0, 0.0, 0.0, 0.0, 0.0], [1e6, 1e3, 1.0, 1e-2, 0.0, 0.0]])
def test_bidiagonalisation(spread):
    """Equal, vanishing and far apart singular values."""
    rng = np.random.default_rng(1)
    left, right = np.linalg.qr(rng.normal(size=(50, 6)))[0], np.linalg.qr(rng.normal(size=(6, 6)))[0]
    x = left * spread @ right.T
    values, v = lanczos_whitening.bidiagonalise(6, 4, lambda w: (x @ w) @ x)
    assert np.allclose(values, spread[:4], rtol=1e-9, atol=1e-9 * spread[0])
    assert np.allclose(v.T @ v, np.eye(4), atol=1e-12)
    assert np.allclose(np.linalg.norm(x @ v, axis=0), values, atol=1e-9 * spread[0])


def test_exact_deviations_beyond_a_long():
    sums = (3 * 10**12, 5)
    model = lanczos_whitening.Whitening(3 * 10**6, sums, np.zeros((2, 0)), np.zeros(0), 1.0)
    x = np.array([[10**6 + 1, 7], [2 * 10**6, 0]], "i8")
    exact = [sum((3 * 10**6 * int(a) - b) ** 2 for a, b in zip(r, sums)) for r in x]
    assert model.deviations(x) == [v if v < 2**63 else None for v in exact] and None in model.deviations(x)
