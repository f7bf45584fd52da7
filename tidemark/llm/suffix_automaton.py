"""Benchmark passages in training text, by a generalised suffix automaton of the items.

Items and texts are normalised to words: A-Z lower-cased, a word is a run of letters, digits and
characters beyond ASCII. All items make one automaton over their words. A text is streamed
through it word by word; after each word the automaton knows the longest run of words that ends
here and stands in some item. A run of at least ``words`` words is a span, and so is a whole
item of fewer words. Each state from that length on knows the items that its window of ``words``
words stands in.

``matched`` returns the spans. ``cleaned`` removes them, and leaves out documents of which more
than a given share is inside spans.

Scale: documents are only mapped, there is no shuffle of them. The items are split into pieces
that overlap by a window less one word, and the pieces into blocks of a bounded number of words
(``BLOCK_WORDS``), however large the benchmark is. One block at a time is fetched, made into an
automaton on the driver and broadcast; its size is therefore bounded, too. With several blocks,
documents and their spans are written between the passes.

Defined results: a null or empty text has no words and no spans. Items without words are left
out; items that repeat count once by their identifier; an item without identifier marks words
but is not listed. Rows that repeat each have their result. An empty benchmark marks nothing.
Other input columns are kept, but for those named like a result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ROW, kept_by_worker, quoted, unpacked
from tidemark.session import durable, forget

#: Most words of benchmark items that one automaton holds: some 300,000 states, 40 MB.
BLOCK_WORDS = 200_000
PIECE_WORDS = 10_000

SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)
_RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _byte_table() -> bytes:
    """Bytes of words as they are (A-Z lower-cased), all others as a space. Characters beyond
    ASCII are made of bytes from 0x80 on."""
    table = bytearray(b" " * 256)
    for b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return bytes(table)


_TABLE = _byte_table()


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The first and the end byte of every word."""
    inside = np.zeros(len(text) + 2, "i1")
    inside[1:-1] = np.frombuffer(text.translate(_TABLE), "u1") != 0x20
    turns = np.diff(inside)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


class Automaton:
    """The suffix automaton of word sequences, each with the identifiers of its items."""

    def __init__(self, items: dict[bytes, Sequence[str]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        texts = []
        for text in items:
            texts.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in text.split(b" ")])
        self.width = len(self.vocabulary) + 1
        self.ids = list(items.values())
        moves: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for text in texts:
            last = 0
            for word in text:
                last = self._step(last, word, moves)
        self.moves = {
            state * self.width + word: to for state, out in enumerate(moves) for word, to in out.items()
        }
        self._mark(texts)

    def _state(self, moves: list, length: int, link: int, out: dict[int, int]) -> int:
        moves.append(out)
        self.length.append(length)
        self.link.append(link)
        return len(moves) - 1

    def _step(self, last: int, word: int, moves: list[dict[int, int]]) -> int:
        """Append a word to the string that ``last`` ends; returns the new end."""
        known = moves[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        new = None if known is not None else self._state(moves, self.length[last] + 1, 0, {})
        at = last
        while new is not None and at >= 0 and word not in moves[at]:
            moves[at][word] = new
            at = self.link[at]
        if at < 0:
            return new
        target = moves[at][word]
        if self.length[target] == self.length[at] + 1:
            self.link[new] = target
            return new
        # the shorter strings of the target get a state of their own
        part = self._state(moves, self.length[at] + 1, self.link[target], dict(moves[target]))
        while at >= 0 and moves[at].get(word) == target:
            moves[at][word] = part
            at = self.link[at]
        self.link[target] = part
        if new is None:
            return part
        self.link[new] = part
        return new

    def _mark(self, texts: list[list[int]]) -> None:
        """For each state, the state of its last ``window`` words and the nearest whole short
        item among its suffixes; for those, the texts they stand in."""
        n, window = len(self.length), self.window
        self.window_state = [-1] * n
        self.short_state = [-1] * n
        shorts: dict[int, list[tuple[int, int]]] = {}
        found: dict[int, set[int]] = {}
        for number, text in enumerate(texts):
            if len(text) < window:
                state = 0
                for word in text:
                    state = self.moves[state * self.width + word]
                shorts.setdefault(state, []).append((len(text), number))
        for state in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= window:
                self.window_state[state] = state if self.length[up] < window else self.window_state[up]
            self.short_state[state] = state if state in shorts else self.short_state[up]
        for number, text in enumerate(texts):
            state = 0
            for word in text:
                state = self.moves[state * self.width + word]
                if self.window_state[state] >= 0:
                    found.setdefault(self.window_state[state], set()).add(number)
        self.found = {state: tuple(sorted(numbers)) for state, numbers in found.items()}
        self.shorts = shorts
        self.least = min([window, *(m for marks in shorts.values() for m, _ in marks)])

    def scan(self, text: Sequence[bytes]) -> tuple[list[list[int]], set[str]]:
        """The spans (first word, end) of a text, joined where they touch or overlap, and the
        identifiers of the items whose windows occur."""
        move, width, link, length_of = self.moves.get, self.width, self.link, self.length
        window, least, short_state = self.window, self.least, self.short_state
        spans: list[list[int]] = []
        windows, seen = set(), set()
        state = length = 0
        for at, word in enumerate(map(self.vocabulary.get, text)):
            if word is None:
                state = length = 0
                continue
            to = move(state * width + word)
            if to is None:
                while to is None:
                    # every word of the vocabulary leaves the first state
                    state = link[state]
                    to = move(state * width + word)
                length = length_of[state]
            state = to
            length += 1
            if length < least:
                continue
            longest = 0
            if length >= window:
                longest = length
                windows.add(self.window_state[state])
            short = short_state[state]
            while short > 0:
                for size, number in self.shorts[short]:
                    if size <= length:
                        longest = max(longest, size)
                        seen.add(number)
                short = short_state[link[short]]
            if longest:
                first = at + 1 - longest
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, at + 1])
        for w in windows:
            seen.update(self.found[w])
        return spans, {i for number in seen for i in self.ids[number]}


def joined(spans: Iterable[Sequence[int]]) -> list[list[int]]:
    """Spans in order, joined where they touch or overlap."""
    out: list[list[int]] = []
    for first, end in sorted(map(tuple, spans)):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def _pieces(benchmark: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """``item`` and ``piece``: the words of an item, in pieces that share all but one word of a
    window with the next, so that every window lies in one of them."""
    rows = benchmark.select(F.col(quoted(key)).cast("string").alias("item"), _bytes(text).alias("piece"))
    step = PIECE_WORDS - window + 1

    def run(batches):
        for batch in batches:
            items, pieces = [], []
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words_of(raw)
                for at in range(0, max(len(found) - window + 1, min(1, len(found))), step):
                    items.append(item)
                    pieces.append(b" ".join(found[at : at + PIECE_WORDS]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(pieces, pa.binary())], ["item", "piece"])

    return rows.mapInArrow(run, rows.schema).distinct()


def _bytes(text: str) -> Column:
    return F.col(quoted(text)).cast("string").cast("binary")


def _pass(rows: DataFrame, pieces: DataFrame, window: int, last: bool) -> DataFrame:
    """Add one block of items to the spans and items found so far."""
    texts: dict[bytes, list[str]] = {}
    for r in pieces.select("item", "piece").collect():
        ids = texts.setdefault(bytes(r.piece), [])
        if r.item is not None:
            ids.append(r.item)
    shared = rows.sparkSession.sparkContext.broadcast((texts, window))
    mark = uuid.uuid4().hex
    names = [ROW, *(() if last else ("_text",)), *_RESULT.names]
    schema = T.StructType(
        [rows.schema[ROW], *([] if last else [T.StructField("_text", T.BinaryType())]), *_RESULT.fields]
    )
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        held = kept_by_worker("automaton", dict)  # the one of this block only
        if held.get("mark") != mark:
            held.clear()
            held.update(mark=mark, automaton=Automaton(*shared.value))
        automaton = held["automaton"]
        for batch in batches:
            counts, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            for raw, (old, named) in zip(batch.column("_text"), before):
                found = words_of(raw.as_py())
                new, seen = automaton.scan(found)
                if old:
                    new = joined([*new, *((s["start"], s["end"]) for s in old)])
                counts.append(len(found))
                spans.append([{"start": a, "end": b} for a, b in new])
                items.append(sorted(seen.union(named)))
            columns = [batch.column(ROW), *(() if last else (batch.column("_text"),))]
            columns += [pa.array(counts, pa.int64()), pa.array(spans, spans_type), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def matched(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = 10,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """All rows with ``n_words``, ``n_hit`` (words inside spans), ``spans`` (first word, end) and
    ``items`` (identifiers as strings, sorted). ``keep`` names the input columns wanted next to
    the result (all if left out)."""
    pieces = durable(_pieces(benchmark, item, item_text, words), "items")
    size = pieces.agg(F.sum(F.length(F.regexp_replace(F.decode("piece", "ISO-8859-1"), "[^ ]", "")) + 1)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_WORDS))
    block = F.pmod(F.xxhash64("item", "piece"), F.lit(blocks))
    wanted = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[F.col(quoted(c)) for c in wanted]).alias(ROW),
        _bytes(text).alias("_text"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for k in range(blocks):
        last = k == blocks - 1
        before, rows = rows, _pass(rows, pieces.filter(block == k), words, last)
        if not last:
            rows = durable(rows.drop("n_words"), "spans")
            if k:
                forget(before)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return unpacked(rows.withColumn("n_hit", hit), "n_words", "n_hit", "spans", "items")


def cleaned(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = 10,
    most_covered: float = 0.5,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents without their spans, with their input columns only. Those with more than
    the share ``most_covered`` of their words inside spans are left out."""
    whole = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), F.col(quoted(text)).alias("text"))
    found = matched(whole, benchmark, words, "text", item, item_text)
    found = found.filter(F.col("n_hit") <= F.col("n_words") * most_covered).select("row", _bytes("text").alias("text"), "spans")

    def run(batches):
        for batch in batches:
            texts = []
            for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if spans:
                    first, end = word_places(raw)
                    cuts = [0, *(x for s in spans for x in (first[s["start"]], end[s["end"] - 1])), len(raw)]
                    raw = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                texts.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["row", "text"])

    schema = T.StructType([found.schema["row"], T.StructField("text", T.BinaryType())])
    out = found.mapInArrow(run, schema)
    return out.select(
        *[
            F.decode("text", "UTF-8").alias(c) if c == text else F.col(f"row.{quoted(c)}").alias(c)
            for c in docs.columns
        ]
    )


def digests(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per document: its key, the counts, and a digest of the items found."""
    found = matched(docs, benchmark, keep=[key], **options)
    return found.select(
        F.col(quoted(key)),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
