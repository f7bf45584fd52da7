"""How far the sources of a language differ in their words: an audit by columnar counts.

Partial counts are made inside ``mapInArrow`` by Arrow's own kernels, column by column: lower
case, split by pattern, dictionary codes, grouped counts. Each task adds up its batches and hands
on one row per language, source and term it saw. Spark adds the partial counts and keeps the terms
that enough documents of their language have. The kept counts are dealt over shards by term; a
shard is a table of one language's sources and some of its terms. Shards compute the divergence of
every two sources over their terms, and the terms that tell a source most from its language; the
sums of the shards are the result.

All arithmetic is on whole numbers. The share of a term is ``1 + floor(10^9 (count + 2) / (N + 2 V))``
with N the group's occurrences of kept terms and V the language's number of kept terms; the
divergence of two shares p and q is ``floor((p - q)^2 / (p + q))``.

Scale: documents are read once and mapped; what is shuffled are counts, added up per task, so a
source with a third of the rows sends no more than its vocabulary per task. A shard holds some
``SHARD_ROWS`` counts whatever the input, and works through them in blocks of sources and terms
of a fixed number of cells. The result itself has a row for every two sources of a language.

Defined results: null texts, languages and sources are empty strings, which are a language and a
source like others. A document without terms still makes its group occur. Rows that repeat count
each. A language without kept terms has pairs of value 0 and no terms. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_of
from tidemark.session import durable

#: What lies between terms: all of ASCII but letters (fixed by the contract).
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
SHARD_ROWS = 200_000
#: Texts are cut into terms so many bytes at a time, and partial counts handed on beyond so many rows.
SLICE_BYTES = 4 << 20
HELD_ROWS = 400_000
#: Cells of a block of counts, and sources compared with all others at a time.
CELLS = 1 << 18
TILE = 256

_COUNTS = "lang string, source string, term string, n long, df long"
_KEYS = ["lang", "source", "term"]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded size; a longer text is a part of its own."""
    size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of every language, source and term of a batch, and a row with
    a null term for every language and source."""
    parts = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=BETWEEN)
    terms, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    filled = pc.not_equal(terms, "")
    coded = terms.filter(filled).dictionary_encode()
    lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
    documents = pa.table({"d": owner.filter(filled), "t": coded.indices})
    documents = documents.group_by(["d", "t"], use_threads=False).aggregate([([], "count_all")])
    doc = documents["d"].combine_chunks()
    groups = pa.table(
        {
            "l": lang.indices.take(doc),
            "s": source.indices.take(doc),
            "t": documents["t"],
            "n": documents["count_all"],
        }
    )
    groups = groups.group_by(["l", "s", "t"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    counts = pa.table(
        {
            "lang": lang.dictionary.take(groups["l"]),
            "source": source.dictionary.take(groups["s"]),
            "term": coded.dictionary.take(groups["t"]),
            "n": groups["n_sum"],
            "df": groups["count_all"],
        }
    )
    seen = pa.table({"l": lang.indices, "s": source.indices})
    seen = seen.group_by(["l", "s"], use_threads=False).aggregate([([], "count_all")])
    occurring = pa.table(
        {
            "lang": lang.dictionary.take(seen["l"]),
            "source": source.dictionary.take(seen["s"]),
            "term": pa.nulls(len(seen), pa.string()),
            "n": pa.array(np.zeros(len(seen), "i8")),
            "df": seen["count_all"],
        }
    )
    return pa.concat_tables([counts, occurring])


def _added(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(_KEYS, use_threads=False)
    out = whole.aggregate([("n", "sum"), ("df", "sum")])
    return out.select([*_KEYS, "n_sum", "df_sum"]).rename_columns([*_KEYS, "n", "df"])


def partial_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts of every task's documents: language, source, term, occurrences, documents."""
    rows = docs.select(
        text_of(lang).alias("lang"), text_of(source).alias("source"), text_of(text).alias("text")
    )

    def run(batches):
        held, new = None, []
        for batch in batches:
            for part in _slices(batch):
                new.append(count_terms(part))
                if sum(map(len, new)) > HELD_ROWS:
                    held, new = _added([*([held] if held else []), *new]), []
                    if len(held) > HELD_ROWS:
                        yield from held.to_batches()
                        held = None
        if held or new:
            yield from _added([*([held] if held else []), *new]).combine_chunks().to_batches()

    return rows.mapInArrow(run, _COUNTS)


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 2) / (total + 2 terms))`` without overflow up to 9 x 10^13."""
    whole = total + 2 * terms
    high = (count + 2) * 10_000
    return 1 + high // whole * 100_000 + high % whole * 100_000 // whole


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by shard and language, one table for each."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        shard = batch.column("shard").to_numpy()
        lang = batch.column("lang").dictionary_encode().indices.to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(shard) != 0) | (np.diff(lang) != 0)) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:]):
            part = batch.slice(a, b - a)
            if parts and any(parts[0].column(c)[0] != part.column(c)[0] for c in ("shard", "lang")):
                yield pa.Table.from_batches(parts)
                parts = []
            parts.append(part)
    if parts:
        yield pa.Table.from_batches(parts)


_PARTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())]
)


def _rows(lang: str, source: pa.Array, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
    n = len(value)
    columns = [pa.array([lang] * n, pa.string()), source, pa.array([part] * n, pa.string()), item, pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=_PARTS)


def compare_sources(shard: pa.Table, best: int) -> Iterator[pa.RecordBatch]:
    """One language's share of the result from one shard: sums of divergences of every two
    sources, and each source's ``best`` terms above the language."""
    lang, number = shard["lang"][0].as_py(), shard["shard"][0].as_py()
    totals = shard.filter(pc.is_null(shard["term"])).sort_by("source")
    counts = shard.filter(pc.is_valid(shard["term"]))
    sources = totals["source"].combine_chunks()
    total, whole, terms = totals["total"].to_numpy(), totals["whole"][0].as_py(), totals["terms"][0].as_py()
    of = pc.index_in(counts["source"], value_set=sources).to_numpy()
    coded = counts["term"].combine_chunks().dictionary_encode()
    at, n = coded.indices.to_numpy(), counts["n"].to_numpy()
    names, size = coded.dictionary, len(coded.dictionary)
    order = np.argsort(at, kind="stable")
    at_sorted = at[order]
    width = max(1, CELLS // max(1, len(sources)))
    for first in range(0, len(sources), TILE):
        tile = np.arange(first, min(first + TILE, len(sources)))
        sums = np.zeros((len(tile), len(sources)), "i8")
        for left in range(0, size, width):
            right = min(left + width, size)
            mine = order[np.searchsorted(at_sorted, left) : np.searchsorted(at_sorted, right)]
            block = np.zeros((len(sources), right - left), "i8")
            block[of[mine], at[mine] - left] = n[mine]
            p = shares(block, total[:, None], terms)
            for k, a in enumerate(tile):
                sums[k, a + 1 :] += divergences(p[a], p[a + 1 :]).sum(1)
        # one shard also names the pairs that no term tells apart
        row, column = np.nonzero((sums > 0) if number else (np.arange(len(sources)) > tile[:, None]))
        if len(row):
            x, y, value = sources.take(tile[row]), sources.take(column), sums[row, column]
            yield _rows(lang, x, "pair", y, value)
            yield _rows(lang, y, "pair", x, value)
    if size:
        everywhere = np.zeros(size, "i8")
        everywhere[at] = counts["everywhere"].to_numpy()
        p, q = shares(n, total[of], terms), shares(everywhere, np.array(whole), terms)[at]
        value = divergences(p, q)
        rank = np.empty(size, "i8")
        rank[pc.sort_indices(names).to_numpy()] = np.arange(size)
        more = np.flatnonzero(p > q)
        more = more[np.lexsort((rank[at[more]], -value[more], of[more]))]
        place = np.arange(len(more)) - np.searchsorted(of[more], of[more])
        more = more[place < best]
        yield _rows(lang, sources.take(of[more]), "term", names.take(at[more]), value[more])


def audited(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = 10,
    best: int = 10,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part ``pair``: the divergence
    from every other source of the language. Part ``term``: the ``best`` terms that the source has
    more of than its language."""
    counts = partial_counts(docs, text, lang, source).groupBy(*_KEYS)
    # read for the kept terms, their counts and the groups
    counts = durable(counts.agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "counts")
    groups = counts.filter(F.col("term").isNull()).select("lang", "source")
    kept = counts.filter(F.col("term").isNotNull()).groupBy("lang", "term")
    kept = kept.agg(F.sum("n").alias("everywhere"), F.sum("df").alias("df")).filter(F.col("df") >= least_documents)
    kept = durable(counts.join(kept.drop("df"), ["lang", "term"]).select(*_KEYS, "n", "everywhere"), "kept")

    per_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_term = kept.groupBy("lang", "term").agg(F.first("everywhere").alias("everywhere"))
    per_lang = per_term.groupBy("lang").agg(F.sum("everywhere").alias("whole"), F.count("*").alias("terms"))
    totals = groups.join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
    totals = totals.na.fill(0, ["total", "whole", "terms"])

    shards = max(1, -(-kept.count() // SHARD_ROWS))
    none, shard = F.lit(None).cast("long"), F.pmod(F.xxhash64("lang", "term"), F.lit(shards))
    # every shard gets the totals of all sources, which its pairs need
    rows = kept.select(
        shard.cast("int").alias("shard"), *_KEYS, "n", "everywhere", *[none.alias(c) for c in ("total", "whole", "terms")]
    ).union(
        totals.select(
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            "lang", "source", F.lit(None).cast("string"), none, none, "total", "whole", "terms",
        )
    )
    rows = rows.repartition(shards, "shard", "lang").sortWithinPartitions("shard", "lang")

    def run(batches):
        for table in _tables(batches):
            yield from compare_sources(table, best)

    parts = rows.mapInArrow(run, "lang string, source string, part string, item string, value long")
    # terms are in one shard each, so their sum is the value itself
    parts = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = parts.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= best))
