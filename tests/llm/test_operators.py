"""Each operator against a brute-force version, and on awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.oracle import compare, connect
from tidemark.llm import (
    chat_windows,
    content_sort,
    dominance_packing,
    jaccard_join,
    page_tree,
    piece_bpe,
    quality_rules,
    site_style,
    token_store,
    toxicity,
    url_lists,
)
from tidemark.llm.byte_bpe import Encoder
from tidemark.llm.components import components
from tidemark.llm.workload import BYTE_BPE, ORACLES, PIECE_BPE, QUERIES
from tidemark.session import scratch_path

SMALL, TINY = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, kept string, score string, keep_id string, _text string, posterior int"


def words(text):
    return WORD.findall(text or "")


def awkward(spark):
    """Nulls, empty and blank texts, a long one, ties, repeated rows, clashing column names."""
    long = "lorem ipsum dolor sit amet consectetur " * 6000
    texts = [None, "", " \n\t ", long, "a b c d e f", "a  b\nc d e f", "A b c d e F", "<|endoftext|> é🙂", "x"]
    rows = [(i, t, "k", "s", "i", "t", 7) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "a b c d e f", None, None, None, None, None), (None,) * 7]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    assert compare(QUERIES[name](spark, TINY), connect(TINY), ORACLES[name])[0] is None


# quality rules


def measures(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_verdicts(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, SMALL).collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        r, (n, _, _, _, again) = rows[i], measures(t)
        assert tuple(r[m] for m in quality_rules.MEASURES) == measures(t)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    labels = [x for x in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if not rows[x.doc_id].base_failed]
    assert np.mean([rows[x.doc_id].kept == x.quality for x in labels]) > 0.98


def test_estimated_accuracies():
    rng, counts = random.Random(3), Counter()
    right = [0.95, 0.9, 0.8, 0.7]
    for _ in range(20000):
        good = rng.random() < 0.8
        counts[tuple(None if rng.random() < 0.2 else int(good == (rng.random() < p)) for p in right)] += 1
    model = quality_rules.estimate(counts, 4)
    assert abs(model.prior - 0.8) < 0.03
    assert np.allclose(model.on_good, right, atol=0.04) and np.allclose(model.on_bad, right, atol=0.06)
    assert quality_rules.estimate({}, 4).prior == 0.9


def test_quality_awkward(spark):
    docs = awkward(spark)
    out = quality_rules.judged(docs)
    assert set(docs.columns) <= set(out.columns) and out.count() == 13
    for r in out.filter("doc_id is not null").collect():
        assert r.n_words == measures(awkward_text(r.doc_id))[0]
    assert quality_rules.good_documents(docs).columns == docs.columns
    assert quality_rules.judged(empty(spark)).count() == 0


def awkward_text(i):
    long = "lorem ipsum dolor sit amet consectetur " * 6000
    return [None, "", " \n\t ", long, "a b c d e f", "a  b\nc d e f", "A b c d e F", "<|endoftext|> é🙂", "x"][i]


# token store


def test_byte_bpe_is_the_library():
    code, rng = Encoder(BYTE_BPE), random.Random(1)
    letters = [chr(c) for c in range(0x260)] + list("  \n\t'srtvemld") * 9 + ["<|endoftext|>", "日", "🙂", " "]
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randint(0, 50)))
        ids = code.tokenizer.encode(text, add_special_tokens=False).ids
        assert code(text) == np.array(ids, "<u4").tobytes()


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    return {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4") for i, x in texts.items()}


def test_token_store(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op2_token_store"](spark, SMALL).collect()}
    start = 0
    for i, ids in sorted(whole_ids(texts).items()):
        r = got.pop(i)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_addressable_codes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.choice(np.array([0, 1, 255, 256, 50000, 65535, 65536, 2**32 - 1], "u4"), n)
        levels = token_store.encode(ids)
        assert (token_store.decode(levels) == ids).all()
        at = rng.integers(0, max(n, 1), min(n, 200))
        assert (token_store.access(levels, at) == ids[at]).all()


def test_store_awkward_and_random_access(spark):
    path = scratch_path(spark, "tokens")
    token_store.write(awkward(spark), path, BYTE_BPE)
    rows = token_store.documents(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows[:2]] == [None, None] and len(rows) == 13
    assert [r.start for r in rows[1:]] == [r.start + r.n_tokens for r in rows[:-1]]
    known = next(r for r in rows if r.doc_id == 4)
    ids = whole_ids({4: "a b c d e f"})[4]
    asked = spark.createDataFrame([(known.start + k,) for k in range(len(ids))] * 2 + [(10**9,)], "position long")
    found = token_store.tokens_at(spark, path, asked).orderBy("position").collect()
    assert [r.id for r in found] == ids.tolist()
    path = scratch_path(spark, "tokens")
    token_store.write(empty(spark), path, BYTE_BPE)
    assert token_store.documents(spark, path).count() == 0


# chats


def test_chats(spark):
    rows = {r.conv_id: r for r in QUERIES["op3_chat_windows"](spark, SMALL).collect()}
    chats = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        chats[r.conv_id].append((r.turn, r.role, r.text or ""))
    control = "</s>[INST] ok [/INST]"
    chats[-1] = [(0, "user", control), (1, "assistant", control)]
    assert rows.keys() == chats.keys()
    for i, turns in chats.items():
        whole = "".join(f"{r}\n{t}\n" for _, r, t in sorted(turns))
        target = "".join(t for _, r, t in sorted(turns) if r == "assistant")
        r = rows[i]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())


def test_chat_windows(spark):
    rng = random.Random(2)
    bits = ["<|end|>", "<|turn user|>", "\\", "\\\\", "</s>", "[INST]", "[/INST]", "<<SYS>>", "a ", "b\n", "é🙂"]
    turns = [(1, 0, "system", "rules here")]
    turns += [
        (1, k, "assistant" if k % 2 == 0 else rng.choice(["us|>er\n", "a|>\nb", "a|", "|>", "\\|>"]), "".join(rng.choices(bits, k=rng.randint(0, 40))))
        for k in range(1, 60)
    ]
    turns += [(2, None, None, None), (None, 1, "assistant", "x"), (3, 1, "assistant", "y"), (3, 1, "assistant", "y")]
    chats = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat_windows.windows(chats, budget=60, history=20)
    back = {r.conv_id: r for r in chat_windows.read_back(out).collect()}
    assert [tuple(t) for t in back[1].turns] == [t[2:] for t in turns[:60]]
    assert list(back[1].targets) == [t[3] for t in turns[:60] if t[2] == "assistant"]
    assert list(back[3].targets) == ["y", "y"] and [tuple(t) for t in back[2].turns] == [("", "")]
    sizes = []
    for r in out.filter("conv_id = 1").orderBy("window").collect():
        marks = re.findall(r"<\|(turn|again) ", r.formatted)
        assert marks == sorted(marks), "repeated turns come first"
        assert r.window == 1 or r.formatted.startswith("<|again system|>\nrules here")
        lengths = [len(words(x.split("|>\n", 1)[1])) + 4 for x in re.split(r"<\|end\|>\n", r.formatted)[:-1]]
        sizes.append((sum(lengths), marks.count("turn")))
    assert len(sizes) > 5 and all(n <= 60 + 8 or own == 1 for n, own in sizes)
    assert chat_windows.digests(chat_windows.windows(chats.limit(0))).count() == 0


def test_chat_windows_have_their_prompts(spark):
    text = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    sizes = {
        1: [("user", 50), ("assistant", 100), ("user", 200), ("assistant", 800)],  # crosses 896
        2: [("system", 20), ("user", 50), ("assistant", 100), ("user", 180), ("assistant", 790)],
        3: [("user", 700), ("assistant", 500)],  # more than the budget
        4: [("user" if k % 2 == 0 else "assistant", 46) for k in range(100)],
        5: [("system", 700), ("user", 60), ("assistant", 300), ("user", 300), ("assistant", 60)],
    }
    turns = [(c, k, role, text(f"{c}_{k}_", n)) for c, x in sizes.items() for k, (role, n) in enumerate(x)]
    chats = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    seen = Counter()
    for r in chat_windows.windows(chats).collect():
        parts = re.findall(r"<\|(turn|again) (\w+)\|>\n\d+_(\d+)_", r.formatted)
        own = [int(k) for kind, _, k in parts if kind == "turn"]
        places = [int(k) for *_, k in parts]
        x = sizes[r.conv_id]
        seen.update((r.conv_id, k) for k in own)
        opening = [0] if x[0][0] == "system" else []
        rest = places[len(opening):] if opening and places[0] == 0 else places
        if own == opening:
            continue
        assert rest == list(range(rest[0], own[-1] + 1)) and (not opening or places[0] == 0)
        if x[own[0]][0] == "assistant":
            assert own[0] - 1 in places
        total = sum(x[k][1] + 4 for k in places)
        if r.conv_id in (1, 2, 4):
            assert total <= 1024 and (rest[0] <= len(opening) or total + x[rest[0] - 1][1] + 4 > 1024)
    assert seen == Counter((c, k) for c, x in sizes.items() for k in range(len(x)))


# toxicity


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, folder).collect()}
    right = []
    for x in spark.read.parquet(f"{folder}/labels.parquet").collect():
        r = rows[x.doc_id]
        assert r.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.held_out:
            right.append((x.toxic, r.score))
    pos, neg = [s for y, s in right if y], [s for y, s in right if not y]
    assert np.mean([[p > n for n in neg] for p in pos]) > 0.95
    assert np.mean([s >= 0.5 for s in neg]) < 0.02


def test_toxicity_awkward(spark):
    labels = spark.createDataFrame([(4, 1), (7, 0), (8, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(awkward(spark), labels)
    out = toxicity.scored(awkward(spark), model)
    assert out.count() == 13 and out.filter("score is null").count() == 0
    assert dict(out.dtypes)["score"] == "double" and dict(out.dtypes)["_text"] == "string"
    none = toxicity.fit(awkward(spark), labels.limit(0))
    assert {r.score for r in toxicity.scored(awkward(spark), none).collect()} == {0.5}
    assert toxicity.scored(empty(spark), none).count() == 0
    assert toxicity.clean_documents(awkward(spark), none).columns == awkward(spark).columns


def test_toxicity_labels_of_other_documents(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_CLASS", 8)
    docs = spark.range(30).selectExpr("id AS doc_id", "concat('word ', IF(id % 3 = 0, 'bad ', 'good '), id) AS text")
    labels = spark.range(600).selectExpr("id AS doc_id", "IF(id < 30, IF(id % 3 = 0, 1, 0), 1) AS toxic")
    model = toxicity.fit(docs, labels)
    same = toxicity.fit(docs, labels.filter("doc_id < 30"))
    assert model.intercept == same.intercept and np.array_equal(model.weights, same.weights)
    scores = {r.doc_id: r.predicted for r in toxicity.scored(docs, model).collect()}
    assert scores == {i: int(i % 3 == 0) for i in range(30)}


# pieces


def test_piece_bpe_is_the_library(texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    model, rng = piece_bpe.PieceModel(PIECE_BPE), random.Random(1)
    letters = [chr(c) for c in range(1, 0x260)] + list("  \n'srtaeon") * 12 + ["<s>", "▁", "日", "🙂", "the", "   "]
    samples = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    samples += ["".join(rng.choices("aetionshr ▁", k=rng.randint(0, 200))) for _ in range(500)]
    for text in [*samples, *list(texts.values())[:200], "the" * 20000]:
        ids = library.encode(text)
        assert model.encode(text).tolist() == ids and model.decode(ids) == library.decode(ids)


def test_piece_round_trip(spark):
    docs = awkward(spark).filter("doc_id is not null")
    back = piece_bpe.decoded(piece_bpe.encoded(docs, PIECE_BPE), PIECE_BPE)
    assert {(r.doc_id, r.text) for r in back.collect()} == {
        (i, awkward_text(i) or "") for i in range(9)
    }
    rows = {r.doc_id: r for r in piece_bpe.digests(awkward(spark), PIECE_BPE).collect()}
    assert rows[1].n_tokens == 0 and rows[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert piece_bpe.digests(empty(spark), PIECE_BPE).count() == 0


# packing


def check_packing(rows, lengths, capacity):
    for piece in rows.values():
        assert [p.piece for p in piece] == list(range(len(piece)))
    total = Counter()
    by_sequence = defaultdict(list)
    for p in (p for piece in rows.values() for p in piece):
        total[p.doc_id] += p.length
        by_sequence[p.sequence_id].append(p)
    assert total == lengths
    for content in by_sequence.values():
        at = 0
        for p in sorted(content, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(by_sequence)


def test_packing(spark, texts):
    rows, ids = defaultdict(list), whole_ids(texts)
    for p in QUERIES["op6_dominance_packing"](spark, SMALL).orderBy("doc_id", "piece").collect():
        rows[p.doc_id].append(p)
        assert zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) == p.ids_crc32
    used = check_packing(rows, {i: len(x) for i, x in ids.items()}, 2048)
    least = -(-sum(map(len, ids.values())) // 2048)
    assert used <= 1.01 * least + 1


def fewest(items, capacity):
    """Brute force: the fewest sequences for a few pieces."""
    best = [len(items)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for r in sorted({r for r in rooms if r >= items[k]}):
            left = list(rooms)
            left.remove(r)
            place(k + 1, [*left, r - items[k]])
        place(k + 1, [*rooms, capacity - items[k]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best[0]


def test_dominance_keeps_the_optimum():
    rng = random.Random(5)
    for _ in range(150):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        fixed, rest = dominance_packing.reduced(Counter(items), 20)
        assert all(sum(p) <= 20 for p, _ in fixed)
        used = Counter(n for p, k in fixed for n in p for _ in range(k)) + Counter(rest)
        assert used == Counter(items)
        left = list(Counter(rest).elements())
        assert sum(k for _, k in fixed) + fewest(left, 20) == fewest(items, 20)


def test_best_fit_is_that_of_single_pieces():
    rng = random.Random(6)
    for _ in range(200):
        items = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 40))), reverse=True)
        rooms = []
        for n in items:
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 12) - n)
        found = dominance_packing.best_fit(Counter(items), 12)
        assert Counter({p: k for p, k in found}).total() == len(rooms)


def test_packing_awkward(spark):
    rows = dominance_packing.packed(awkward(spark), BYTE_BPE, capacity=64, with_ids=True)
    whole = dominance_packing.sequences(rows).collect()
    assert all(len(r.ids) // 4 <= 64 for r in whole)
    assert sum(len(r.ids) // 4 for r in whole) == rows.groupBy().sum("length").first()[0]
    assert dominance_packing.packed(empty(spark), BYTE_BPE).count() == 0


# url lists


def test_url_lists(spark):
    entries = spark.createDataFrame(
        [("spam", "a.example.com", 1, True), ("spam", "a.example.com", 5, False), ("spam", "a.example.com", 9, True)]
        + [("spam", "example.com", 3, True), ("bad", "a.example.com/x?y", 2, True), ("bad", "z", 4, False)]
        + [("bad", "tie.org", 2, False), ("bad", "tie.org", 2, True), (None, "n.org", 1, True), ("bad", "n.org", None, True)],
        "list string, pattern string, at int, listed boolean",
    )
    urls = ["http://www.A.example.com:80/x?y#f", "https://b.example.com/", "ftp://u@tie.org", "n.org", None, "", "a.example.com"]
    captures = spark.createDataFrame([(i, u, t) for i, u in enumerate(urls) for t in (0, 2, 6, 10, None)], "page_id long, url string, fetched int")
    got = {(r.page_id, r.fetched): (r.lists, r.matched) for r in url_lists.judged(captures, entries).collect()}
    assert got[0, 0] == ("", "") and got[0, 2] == ("bad,spam", "a.example.com/x?y,a.example.com")
    assert got[0, 6] == ("bad,spam", "a.example.com/x?y,example.com")
    assert got[6, 10] == ("spam", "a.example.com") and got[1, 2] == ("", "") and got[1, 6] == ("spam", "example.com")
    assert got[2, 2] == ("bad", "tie.org") and got[3, 10] == got[4, 10] == got[5, 10] == got[0, None] == ("", "")
    assert url_lists.judged(captures, entries.limit(0)).filter("listed").count() == 0


# near duplicates


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])):
                n = len(sets[a] & sets[b])
                if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op8_jaccard_join"](spark, SMALL).collect()}
    assert got == linked(texts)


def test_near_duplicates_around_the_threshold(spark):
    """A large group of copies on both sides of the threshold, chains, passages, tiny texts."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts = {}
    for i in range(400):
        w = list(base)
        for k in rng.sample(range(150), rng.randint(0, 7)):
            w[k] = f"v{rng.randint(0, 400)}"
        texts[i] = " ".join(w)
    for i in range(400, 500):
        own = " ".join(f"u{rng.randint(0, 99999)}" for _ in range(rng.randint(0, 80)))
        texts[i] = f"{own} {passage}"
    chain = [f"c{k}" for k in range(100)]
    for i in range(500, 530):
        chain[rng.randrange(100)] = f"d{i}"
        texts[i] = " ".join(chain)
    for i in range(530, 560):
        texts[i] = " ".join(rng.choices("abc", k=rng.randint(0, 7)))
    texts |= {560: texts[3].upper(), 561: texts[3].replace(" ", "\n "), 562: "", 563: " ", 564: passage}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == linked(texts)


def test_near_duplicates_awkward(spark):
    rows = jaccard_join.near_duplicates(awkward(spark)).collect()
    found = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert len(rows) == 13 and found[4] == found[5] == found[6] == 4 and found[1] == 1
    assert jaccard_join.near_duplicates(empty(spark)).count() == 0
    assert jaccard_join.distinct_documents(awkward(spark)).columns == awkward(spark).columns


# exact duplicates


def test_content_sort_awkward(spark, monkeypatch):
    monkeypatch.setattr(content_sort, "HOT_SHARE", 0.2)  # so that a text of this table is hot
    out = content_sort.grouped(awkward(spark)).collect()
    by_text = defaultdict(list)
    for r in out:
        by_text[r.text_sha256].append(r)
    for group in by_text.values():
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert sum(r.kept for r in group) == 1 and {r.group_size for r in group} == {len(group)}
        assert {r.keep_id for r in group} == {min(ids) if ids else None}
    assert sorted(len(g) for g in by_text.values()) == [1, 1, 1, 1, 1, 3, 5]
    kept = content_sort.distinct_documents(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == 7
    assert content_sort.grouped(empty(spark)).count() == 0


# pages


def page(body, title="t"):
    return f"<html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_markup(spark):
    pages = [
        (0, "http://a.example/1", page('<nav><a>menu</a></nav><div class="ad">buy</div><article><h1>T &amp; t</h1><p>one <b>two<br><p>three&nbsp;x\n y</p><form><input><p>f</p></form><div id="comments"><p>c</p></div><script>var t="</p>";</script></article><footer>f</footer>')),
        (1, None, None),
        (2, "not a url", "plain &lt;text&gt; only"),
        (3, "http://a.example/2", "<article><p>never <!-- gone --> closed &copy <td>cell <aside>s"),
        (3, "http://a.example/2", "<article><p>never <!-- gone --> closed &copy <td>cell <aside>s"),
        (4, "http://a.example/3", "a < b and <"),
    ]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = [(r.page_id, r.text) for r in site_style.main_text(rows).orderBy("page_id").collect()]
    assert got == [
        (0, "T & t\none two\nthree\xa0x y"),
        (1, ""),
        (2, "plain <text> only"),
        (3, "never closed ©\ncell"),
        (3, "never closed ©\ncell"),
        (4, "a < b and <"),
    ]
    assert site_style.main_text(rows.limit(0)).count() == 0


def test_style_tree_cuts_what_pages_share(spark):
    pages = [
        (i, "https://site.example/%d" % i, page(f'<div class="x"><div>Same line on all pages</div></div><div class="y"><p>own text {i}</p>' + "<p>more {i}</p>" * (i % 4) + "</div>"))
        for i in range(40)
    ]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in site_style.main_text(rows).collect()}
    assert all(t.startswith(f"own text {i}") and "Same line" not in t for i, t in got.items())


def test_articles(spark):
    import html

    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [html.unescape(re.sub("<[^>]+>", "", b)) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        blocks = [re.sub(r"[\x20\x09-\x0D]+", " ", b).strip(" ") for b in blocks]
        assert site_style._main_text(r.html, frozenset()) == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("tag", sorted(page_tree.EMBEDDED))
def test_embedded_elements(tag):
    text = lambda body: site_style._main_text(page(body), frozenset())
    assert text(f"<article><p>a <{tag} class='icon'/> b</p><p>c</p></article>") == "a\nb\nc"
    assert text(f"<article><p>a</p><{tag}><p>no</p></{tag}><p>b</p></article>") == "a\nb"
    assert text(f"<article><p>a</p><{tag}><p>b</p></article><article><p>c</p></article>") == "a\nb\nc"
    assert text(f"<{tag}><article><p>a</p></article>") == "a"


@pytest.mark.parametrize("tag", sorted(page_tree.RAW))
def test_raw_text_elements(tag):
    text = lambda body: site_style._main_text(f"<body>{body}", frozenset())
    assert text(f"<article><p>a</p><{tag}><p>no</p></{tag}><p>b</p></article>") == "a\nb"
    assert text(f"<article><p>a</p><{tag} x='y'/><p>b</p></article>") == "a\nb"
    assert text(f"<article><svg><{tag}/></svg><p>a</p><{tag}>no</{tag}></article>") == "a"
    assert text(f"<article><p>a</p><{tag}><p>no</p></article>") == "a"


@pytest.mark.parametrize(
    "body, want",
    [
        ("<div class='layout has-sidebar'><article><p>a</p></article></div>", "a"),
        ("<div id='page' class='banner'><article><p>a</p></article></div>", "a"),
        ("<div class='sidebar'><main><p>a</p></main></div>", "a"),
        ("<article><h2 id='discussion'>a</h2><p class='notice'>b</p></article>", "a\nb"),
        ("<article><section id='search-methods'><p>a</p></section><div class='form-2'>b</div></article>", "a\nb"),
        ("<article><div data-id='ad' data-role=ad title='class=ad'>a</div><div ID=ad>b</div></article>", "a"),
        ("<article><div class='x sidebar'>a</div><p>b</p></article>", "b"),
        ("<article><p>a</p></article><article class='comment'><p>b</p></article>", "a"),
        ("<article><p>a</p><div id='comments'><article><p>b</p></article></div></article>", "a"),
        ("<div id='comments'><h3>c</h3><article class='comment'><p>b</p></article></div><div>a</div>", "a"),
        ("<div class='discussion'><article><p>a</p></article></div>", "a"),
    ],
)
def test_names(body, want):
    assert site_style._main_text(page(body), frozenset()) == want


def test_style_tree_overrules_articles(spark):
    own = lambda h, i: f"{h} own text of page {i}"
    hosts = {
        # repeated in the article of every page, by the same element as the rest
        "lines": (12, lambda h, i: f"<nav>{own(h, i)}</nav><article><h1>T{i}</h1><p>{own(h, i)}</p><p>Subscribe and get a long letter from us every week</p></article>"),
        "few": (4, lambda h, i: f"<article><p>{own(h, i)}</p><p>Licence</p></article>"),
        # an element on some pages only, always the same
        "rare": (20, lambda h, i: f"<article><p>{own(h, i)}</p>" + "<div class='lic'>Licence</div>" * (i < 8) + "</article>"),
        # no article
        "plain": (12, lambda h, i: f"<div class='a'><p>{own(h, i)}</p><p>Licence</p></div><div class='b'>Menu</div>"),
        # the story is beside a short article, or the only article is a box
        "beside": (12, lambda h, i: f"<div class='s'><p>{own(h, i) * 9}</p></div><article><p>T{i}</p></article>"),
        "box": (12, lambda h, i: f"<div class='s'><p>{own(h, i)}</p></div><article><p>Our offers</p></article>"),
        "one": (1, lambda h, i: f"<div class='s'><p>{own(h, i) * 9}</p></div><article><p>T{i}</p></article>"),
        # less text beside an article is not main text
        "aside": (12, lambda h, i: f"<div class='s'><p>{own(h, i)}</p></div><article><p>{own(h, i) * 3}</p></article>"),
        # copies of one page stay
        "copies": (12, lambda h, i: "<article><h1>T</h1><p>the same text</p></article>"),
        # a third of the pages repeat a paragraph
        "third": (12, lambda h, i: f"<article><p>{own(h, i)}</p>" + "<p>part</p>" * (i < 4) + "</article>"),
    }
    want = {
        "lines": lambda h, i: f"T{i}\n{own(h, i)}",
        "few": own,
        "rare": own,
        "plain": own,
        "beside": lambda h, i: f"{own(h, i) * 9}\nT{i}",
        "box": own,
        "one": lambda h, i: f"{own(h, i) * 9}\nT{i}",
        "aside": lambda h, i: own(h, i) * 3,
        "copies": lambda h, i: "T\nthe same text",
        "third": lambda h, i: own(h, i) + "\npart" * (i < 4),
    }
    pages = [(f"{h} {i}", f"http://{h}.example/{i}", page(body(h, i))) for h, (n, body) in hosts.items() for i in range(n)]
    rows = spark.createDataFrame(pages, "page_id string, url string, html string")
    got = {r.page_id: r.text for r in site_style.main_text(rows).collect()}
    assert got == {f"{h} {i}": want[h](h, i) for h, (n, _) in hosts.items() for i in range(n)}


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    rng = random.Random(4)
    shuffled = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in [*chain, *star, (5000, 5001), (7, 7), (5001, 5000)]]
    links = spark.createDataFrame(rng.sample(shuffled, len(shuffled)), "a long, b long")
    roots = {r.node: r.root for r in components(links).collect()}
    wanted = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(400)} | {5000: 5000, 5001: 5000}
    assert roots == wanted
    assert components(links.limit(0)).count() == 0


def test_prefixes_are_lengthened_by_cost(spark, monkeypatch):
    """Texts without costly shingles stay at few matches, near copies get many."""
    made = {}
    postings = jaccard_join._postings
    monkeypatch.setattr(jaccard_join, "_postings", lambda c: made.setdefault("rows", postings(c)))
    monkeypatch.setattr(jaccard_join, "forget", lambda df: None)
    jaccard_join.near_duplicates(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).count()
    matches = {r.sid: r.matches for r in made["rows"].collect()}
    assert len(set(matches.values())) > 3 and max(matches.values()) == jaccard_join.MOST_MATCHES


def long_texts(n=20, shared=20):
    """Long texts of their own words, each with short passages of two other ones."""
    texts = []
    for i in range(n):
        own = [f"o{i}_{k}" for k in range(1200)]
        for k in range(shared):
            for j in (i, (i + 1) % n):
                own[30 * k + 15 * (j == i)] = " ".join(f"p{j}_{k}_{m}" for m in range(7))
        texts.append((i, " ".join(own)))
    return texts


def test_long_texts_with_chance_shingles_are_dropped(spark):
    """Shingles shared with different texts do not make a long text a candidate, also where the
    order does not know them; near copies of a long text stay."""
    made = long_texts()
    copies = [(100, made[0][1] + " a b c"), (101, "d e f " + made[0][1])]
    unknown = (np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(1 << 10, "u1"))

    def possible(texts):
        rows = spark.createDataFrame(texts, "key long, text string").repartition(3)
        return {r.key for r in jaccard_join._possible(jaccard_join._signed(rows, unknown)).collect()}

    assert possible(made) == set()
    assert possible(made + copies) == {0, 100, 101}
    docs = spark.createDataFrame(made + copies, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == {i: 0 if i >= 100 else i for i, _ in made + copies}


def test_order_knows_repeated_shingles_beyond_the_most_frequent(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", 0)
    rows = spark.createDataFrame(long_texts(6), "key long, text string").coalesce(1)
    tokens, counts, repeated = jaccard_join.frequent_shingles(rows)
    assert len(tokens) == len(counts) == 0 and np.unpackbits(repeated).sum() == 6 * 20 * 3
    signed = jaccard_join._signed(rows, (tokens, counts, repeated)).collect()
    prefixes = [t for r in signed for t in r.prefix]
    assert len(prefixes) == len(set(prefixes))  # those that two texts share come last


def test_whole_sets_know_their_hubs(spark):
    """A text with a hub, a hub that has one itself, a hub without, and a text without."""
    keys = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40)], "sid long, key long")
    chosen = spark.createDataFrame([(1, 2), (2, 3)], "sid long, hub long")
    wanted = jaccard_join._wanted(keys, chosen)
    assert {(r.sid, r.key, r.hub, r.leads) for r in wanted.collect()} == {(1, 10, 2, None), (2, 20, 3, True), (3, 30, None, True)}
    tokens = {1: [1, 2, 3, 4], 2: [1, 2, 3, 5], 3: [2, 3, 5, 6]}
    sets = wanted.join(spark.createDataFrame(list(tokens.items()), "sid long, tokens array<long>"), "sid")
    compared = {(r.sid, r.hub, r.hub_n, r.u) for r in jaccard_join._compared(sets).collect()}
    assert compared == {(1, 2, 4, 9), (2, 3, 4, 9)}
