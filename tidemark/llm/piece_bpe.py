"""SentencePiece merge-type encoding without merging: longest matches and backtracking.

A sequence of tokens is the encoding of its text exactly when every two neighbours are
compatible, that is when merging their joined text gives back these two tokens. So a text is
encoded from left to right: the longest token that starts here (found for all places in one
Aho-Corasick pass) is taken if it is compatible with the token before it, else its next shorter
prefix that is a token. If none is left, the last token is taken back and its end marked in a
bitfield as failed, so no place is tried twice from the same state.

A merge never joins a word's characters with a following space mark, and unknown characters
are never merged, so words are encoded one by one. A task remembers a bounded number of words
and of neighbour checks. Rows are independent: there is no shuffle.

Defined results: a null text is an empty one; an empty text has no ids and decodes to an empty
text. Rows that repeat each have their result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import kept_by_worker, quoted, text_of

MARK = "▁"  # stands for a space in the vocabulary; here pieces are spelled with the space
KNOWN_WORDS = 800_000
KNOWN_PAIRS = 1_000_000


class PieceModel:
    """The vocabulary of a merge-type model, and exact encoding and decoding with it."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = {i for i in range(size) if model.is_unknown(i) or model.is_control(i)}
        bytes_ = [i for i in range(size) if model.is_byte(i)]
        if len(bytes_) != 256 or model.encode("a", out_type=str)[0][0] != MARK:
            raise ValueError("only models with byte fallback and a leading space mark are served")
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in bytes_}
        plain = [i for i in range(size) if i not in special and i not in set(bytes_)]
        self.id_of = {model.id_to_piece(i).replace(MARK, " "): i for i in plain}
        self.score = {p: model.get_score(i) for p, i in self.id_of.items()}
        if any(" " in p.lstrip(" ") for p in self.id_of):
            raise ValueError("a piece has a space mark after other characters")
        self.spelled = [b""] * size
        for piece, i in self.id_of.items():
            self.spelled[i] = piece.encode()
        for value, i in self.byte_id.items():
            self.spelled[i] = bytes([value])
        self.decimal = [str(i) for i in range(size)]

        self.characters = {p for p in self.id_of if len(p) == 1}
        # a line end that is no piece's part is a word of its own
        line = "" if any("\n" in p for p in self.id_of) else "\n"
        self.words = re.compile(f" *[^ {line}]+| +" + (f"|{line}" if line else ""))
        # pieces that merging can make; the others never occur
        self.reached = {p for p in self.id_of if self.merged(p) == [p]}
        self.shorter = {p: self._prefix(p[:-1]) for p in self.reached}
        self.finder = ahocorasick.Automaton()
        for p in self.reached:
            self.finder.add_word(p, p)
        self.finder.make_automaton()
        self.known: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _prefix(self, text: str) -> str | None:
        while text and text not in self.reached:
            text = text[:-1]
        return text or None

    def merged(self, text: str) -> list[str]:
        """The definition: join the neighbours whose join has the best score, leftmost first,
        until no two neighbours make a piece."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            found = self.merged(left + right) == [left, right]
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def split(self, text: str) -> list[str]:
        """The encoding of a text whose characters are all known."""
        longest: list[str | None] = [None] * (len(text) + 1)
        for end, piece in self.finder.iter(text):
            start = end - len(piece) + 1
            if longest[start] is None or len(longest[start]) < len(piece):
                longest[start] = piece
        open_ = bytearray(b"\1") * (len(text) + 1)  # 0: no encoding of the rest starts here
        tokens: list[str] = []
        at, token = 0, longest[0]
        while at < len(text):
            while token is not None:
                end = at + len(token)
                if open_[end] and (not tokens or self.compatible(tokens[-1], token)):
                    break
                token = self.shorter[token]
            if token is not None:
                tokens.append(token)
                at += len(token)
                token = longest[at]
            else:
                open_[at] = 0
                last = tokens.pop()
                at -= len(last)
                token = self.shorter[last]
        return tokens

    def _word(self, word: str) -> bytes:
        if self.characters.issuperset(word):
            return array("I", map(self.id_of.__getitem__, self.split(word))).tobytes()
        ids: list[int] = []
        run = ""
        for known, c in [(c in self.characters, c) for c in word] + [(False, "")]:
            if known:
                run += c
                continue
            if run:
                ids += [self.id_of[t] for t in self.split(run)]
                run = ""
            ids += [self.byte_id[b] for b in c.encode()]
        return array("I", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        known, out = self.known, []
        for word in self.words.findall(" " + text.replace(MARK, " ")):
            ids = known.get(word)
            if ids is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                ids = known[word] = self._word(word)
            out.append(ids)
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: Sequence[int]) -> str:
        """Pieces joined, bytes that make no character replaced one by one, without the space
        that encoding puts in front."""
        spelled = b"".join(map(self.spelled.__getitem__, ids))
        try:
            text = spelled.decode()
        except UnicodeDecodeError:
            text = "".join(_characters(spelled))
        return text[1:] if text.startswith(" ") and ids[0] != self.byte_id[32] else text


def _characters(spelled: bytes) -> Iterable[str]:
    at = 0
    while at < len(spelled):
        for n in range(1, 5):
            try:
                yield spelled[at : at + n].decode()
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            at += 1


def model(path: str) -> PieceModel:
    return kept_by_worker(("piece_bpe", path), lambda: PieceModel(path))


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``ids`` (little-endian 32-bit integers) of every text."""
    rows = docs.select(F.col(quoted(key)), text_of(text).alias("_text"))
    schema = T.StructType([rows.schema[0], T.StructField("ids", T.BinaryType())])

    def run(batches):
        m = model(path)
        for batch in batches:
            ids = [m.encode(x.as_py()).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The key and the text of every row of ids; null ids give an empty text."""
    rows = rows.select(F.col(quoted(key)), F.col(quoted(ids)).alias("_ids"))
    schema = T.StructType([rows.schema[0], T.StructField("text", T.StringType())])

    def run(batches):
        m = model(path)
        for batch in batches:
            texts = [m.decode(np.frombuffer(x.as_py() or b"", "<u4").tolist()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, decode the ids again, and return digests of both."""
    rows = docs.select(F.col(quoted(key)), text_of(text).alias("_text"))
    schema = T.StructType(
        [
            rows.schema[0],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def sha256(x: str) -> str:
        return hashlib.sha256(x.encode()).hexdigest()

    def run(batches):
        m = model(path)
        for batch in batches:
            counts, written, texts = [], [], []
            for x in batch.column(1):
                ids = m.encode(x.as_py()).tolist()
                counts.append(len(ids))
                written.append(sha256(",".join(map(m.decimal.__getitem__, ids))))
                texts.append(sha256(m.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(written, pa.string()), pa.array(texts, pa.string())],
                schema.names,
            )

    return rows.mapInArrow(run, schema)
