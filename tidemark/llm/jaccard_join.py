"""Near duplicates: an exact Jaccard self-join of shingle sets with adaptive multi-match
prefixes, and the components of its links.

*Classes.* Texts with the same word sequence have the same set; one row stands for them.

*Order.* Sets are sorted by one order of shingles: those that many texts share last. Frequent
shingles are found by counting within tasks (a shingle that is frequent overall repeats within
a task) and adding up. The most frequent, at most ``2**20`` of them or 16 MB, go to the tasks with
their counts; the others that repeat come before them, told by a bitmap, and those that do not
repeat come first. Any order gives the same result; this one keeps passages that texts share out of
the prefixes.

*Prefixes.* Similar sets of at most ``n`` shingles share ``ceil(0.8 n)``, so they share at
least ``k`` among the first ``n - ceil(0.8 n) + k`` of both, for any ``k``. So a text that has fewer
than ``k`` such shingles in common with any others, for one ``k`` of the ``LADDER`` or for a share
of its own size, is dropped: most have no partner at all. (The longer a text, the more of its
shingles some other text has by chance, so a fixed ``k`` would drop no long text.) For each text that is left the shingles' counts estimate what each ``k``
costs: the texts met at the prefix, and of these at most one in ``k`` to compare. The prefix is
lengthened as long as that pays, which differs from text to text: copies of one text share rare
shingles, so a longer prefix saves comparisons; where the next shingles are those of a common
passage, it would only meet more texts. Two texts must share the smaller of their two ``k`` before
they are compared.

*Hubs.* A group of near copies would meet in every prefix shingle of the group. So each text is
first compared with a hub: of the texts that share a prefix shingle, the one whose prefix is met
most. With ``r`` shingles of the hub missing and ``a`` others added, let ``u = 5 r + 4 a``. A text
is similar to its hub ``h`` if ``u <= |h|``, and two texts of one hub are similar if and only if 9
times the number of deviations they share is at least ``u + u' - |h|``. So texts near one hub are
joined by prefixes of their deviations, which are few and mostly each text's own: copies of one
text cost about as many rows as there are copies, also where many are just not similar. In the
shingle join, texts near one hub never meet: for each prefix shingle the largest such group
meets the others, and those meet each other. No link is lost but inside what is connected.

*Comparison.* Whole sets of the texts with a partner are made in a second pass over the texts,
which skips the others by a bitmap of fixed size, and intersected natively. Links are exact but
for collisions of 64-bit hashes.

Defined results: null, empty and blank texts have the empty set and are linked with nothing. A
null key takes part; a component's smallest key ignores nulls. Rows that repeat belong to one
class. An empty table gives an empty result. Input columns other than key and text are not
carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import quoted, text_of
from tidemark.llm.components import components
from tidemark.llm.shingles import Hasher
from tidemark.session import durable, forget

WORDS = 5
PERCENT = 80
CHUNK = 1 << 20  # shingles that a task counts at a time
MOST_FREQUENT = 1 << 20  # shingles whose count the order knows
LADDER = (1, 2, 4, 8, 16, 24)  # matches that a prefix may be lengthened to
FIRST_MATCHES, MOST_MATCHES = 16, LADDER[-1]  # the first sieve looks at prefixes for so many
SHARE = 20  # or, in long texts, for this part of their shingles
COMPARISON = 16  # what comparing two texts costs, in texts met
MAP_BITS = 24  # of the bitmap of texts, 2 MB
ORDER_BITS = (20, 27)  # of the bitmap of repeated shingles, up to 16 MB; a clash only moves a shingle back
SHINGLE_BITS = (20, 30)  # of the bitmap of shared shingles, up to 128 MB
BITS_PER_SHINGLE = 16  # one in so many places is set, so texts without a partner pass no more often as data grow


def needed(n: Column) -> Column:
    """The least overlap of two similar sets of which the larger has ``n`` shingles."""
    return F.ceil(n * PERCENT / 100)


def _needed(n):
    return -(-n * PERCENT // 100)


def first_matches(n: Column) -> Column:
    """The matches for which the first sieve looks in a set of ``n`` shingles."""
    return F.least(needed(n), F.greatest(F.lit(FIRST_MATCHES), F.floor(n / SHARE)))


def _first_matches(n: np.ndarray) -> np.ndarray:
    return np.minimum(_needed(n), np.maximum(FIRST_MATCHES, n // SHARE))


def frequent_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles that texts share often, sorted by hash, their counts, and a bitmap of the others
    that repeat."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = Hasher(WORDS), [], 0

        def report() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(found[n > 1]), pa.array(n[n > 1].astype("i8"))], ["token", "n"]
            )

        for batch in batches:
            for value in batch.column("text"):
                tokens = hasher.shingles(hasher.words(value.as_py()))
                held.append(tokens)
                size += len(tokens)
                if size >= CHUNK:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()

    repeated = rows.select("text").mapInArrow(count, "token long, n long")
    counted = durable(repeated.groupBy("token").agg(F.sum("n").alias("n")), "repeated")
    # counts by quarter powers of two, the most frequent first, as far as the table may go
    step = F.ceil(4 * F.log2("n"))
    kept, least, left = 0, None, 0
    for power, here in sorted(counted.groupBy(step).count().collect(), reverse=True):
        kept += here
        if kept > MOST_FREQUENT:
            left += here
        else:
            least = power
    known = F.lit(False) if least is None else step >= least
    table = counted.filter(known).toArrow()
    others = _bitmap(counted.filter(~known), F.col("token"), _bits(left, *ORDER_BITS))
    forget(counted)
    tokens, n = table["token"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], n[order], others


def in_order(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Sorted shingles in the join's order: those that are not known to repeat first, by hash, then
    those of the bitmap, by hash, then the frequent ones by count."""
    count = _inside(repeated, tokens & ((len(repeated) << 3) - 1)).astype("i8")
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        count = np.where(frequent[at] == tokens, counts[at], count)
    return tokens[np.argsort(count, kind="stable")]


def _signed(rows: DataFrame, frequent: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Per row: its key, the hash of its word sequence, the size of its set, and as much of the
    ordered set as the longest prefix needs."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    schema = T.StructType(
        [
            rows.schema["key"],
            T.StructField("sid", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("prefix", T.ArrayType(T.LongType())),
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Hasher(WORDS), shared.value
        for batch in batches:
            sids, sizes, prefixes = [], [], []
            for value in batch.column("text"):
                words = hasher.words(value.as_py())
                tokens = hasher.shingles(words)
                n = len(tokens)
                sids.append(hasher.sequence(words))
                sizes.append(n)
                longest = n - _needed(n) + max(MOST_MATCHES, n // SHARE)
                prefixes.append(in_order(tokens, *known)[:longest])
            ends = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate([np.zeros(0, "i8"), *prefixes])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(sids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())),
                ],
                schema.names,
            )

    return rows.select("key", "text").mapInArrow(sign, schema)


def _bits(values: int, least: int, most: int) -> int:
    """The bits by which places of a bitmap for so many shingles are numbered."""
    return min(most, max(least, (BITS_PER_SHINGLE * values - 1).bit_length()))


def _bitmap(values: DataFrame, hashed: Column, bits: int) -> np.ndarray:
    """A bitmap of ``2**bits`` bits in which the values' hashes are set, of that size whatever
    the number of values."""
    place = F.pmod(hashed, F.lit(1 << bits))
    parts = (
        values.select(F.floor(place / 32768).alias("part"), F.pmod(place, F.lit(32768)).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    found = np.zeros(1 << (bits - 3), "u1")
    for p in parts:
        found[p.part * 4096 : (p.part + 1) * 4096] = np.frombuffer(p.bits, "u1")
    return found


def _inside(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype("u1")) & 1 == 1


def _possible(signed: DataFrame) -> DataFrame:
    """The classes that may have a partner, with key, size and prefix: those that for each step
    of the ladder, and for their share, have enough prefix shingles that some other text has in its
    prefix too. (The smallest partner of ``n`` shingles has ``needed(n)`` and shares what it needs
    itself.) Copies of a text and clashes in the bitmap let some others pass."""
    length = (F.col("n") - needed(F.col("n")) + first_matches(F.col("n"))).cast("int")
    first = signed.filter("n > 0").select("sid", F.explode(F.slice("prefix", 1, length)).alias("token"))
    # 40 bits keep the shuffle small; a clash, like a copy of one text, only lets a text pass
    met = first.groupBy(F.pmod("token", F.lit(1 << 40)).alias("token")).count().filter("count > 1")
    met = durable(met.select("token"), "shared")
    size = _bits(met.count(), *SHINGLE_BITS)
    shared = signed.sparkSession.sparkContext.broadcast(_bitmap(met, F.col("token"), size))
    forget(met)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, mask = shared.value, (1 << size) - 1
        for batch in batches:
            n = batch.column("n").to_numpy()
            prefix = batch.column("prefix")
            ends = prefix.offsets.to_numpy()
            hits = np.cumsum(np.concatenate([[0], _inside(bits, prefix.values.to_numpy() & mask)]))
            least = _needed(n)
            keep = n > 0
            steps = [np.minimum(k, least) for k in LADDER if k <= FIRST_MATCHES]
            for k in [*steps, _first_matches(n)]:
                stop = np.minimum(ends[:-1] + n - least + k, ends[1:])
                keep &= hits[stop] - hits[ends[:-1]] >= np.minimum(k, _first_matches(least))
            yield batch.take(pa.array(np.flatnonzero(keep)))

    sifted = signed.mapInArrow(sift, signed.schema)
    return sifted.groupBy("sid").agg(
        F.min("key").alias("key"), F.first("n").alias("n"), F.first("prefix").alias("prefix")
    )


def _whole_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The whole sets of the ``wanted`` classes, each from the text of its smallest key, with what
    else ``wanted`` holds."""
    shared = rows.sparkSession.sparkContext.broadcast(_bitmap(wanted, F.xxhash64("key"), MAP_BITS))
    place = F.pmod(F.xxhash64("key"), F.lit(1 << MAP_BITS)).alias("place")
    schema = T.StructType(
        [
            rows.schema["key"],
            T.StructField("sid", T.LongType()),
            T.StructField("tokens", T.ArrayType(T.LongType())),
        ]
    )

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = Hasher(WORDS), shared.value
        for batch in batches:
            keep = np.flatnonzero(_inside(bits, batch.column("place").to_numpy()))
            batch = batch.take(pa.array(keep))
            sids, sets = [], []
            for value in batch.column("text"):
                words = hasher.words(value.as_py())
                sids.append(hasher.sequence(words))
                sets.append(hasher.shingles(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                schema.names,
            )

    made = rows.select("key", "text", place).mapInArrow(shingle, schema)
    # rows of one class have one set, whichever of them passed the bitmap
    found = made.select("sid", "tokens").join(wanted.drop("key"), "sid")
    return durable(found.dropDuplicates(["sid"]), "sets")


def _wanted(keys: DataFrame, chosen: DataFrame) -> DataFrame:
    """The keys of texts with a hub, with ``hub``, and of hubs, told by ``leads``; so the whole sets
    need not be shuffled once more to find out."""
    hubs = chosen.select(F.col("hub").alias("sid")).distinct().withColumn("leads", F.lit(True))
    return keys.join(chosen.join(hubs, "sid", "full"), "sid")


def _texts(pairs: DataFrame) -> DataFrame:
    """The distinct texts of a table of pairs."""
    a, b = pairs.columns
    return pairs.select(F.col(a).alias("sid")).union(pairs.select(F.col(b).alias("sid"))).distinct()


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole sets are similar."""
    left = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("_s"))
    right = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("_t"))
    common = F.size(F.array_intersect("_s", "_t"))
    union = F.size("_s") + F.size("_t") - common
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.filter(100 * common >= PERCENT * union).select("a", "b")


def _alike_in_size(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _postings(classes: DataFrame) -> DataFrame:
    """Prefix shingles of the classes that have a possible partner: (token, sid, n, matches,
    cost). ``matches`` is the step of the ladder with the least estimated cost, ``cost`` the
    number of texts met at its prefix."""
    need = needed(F.col("n"))
    longest = (F.col("n") - need + F.least(F.lit(MOST_MATCHES), need)).cast("int")
    places = classes.select("sid", "n", F.posexplode(F.slice("prefix", 1, longest)).alias("place", "token"))
    met = durable(places.groupBy("token").count().filter("count > 1"), "met")
    places = durable(places.join(met, "token"), "places")
    sums, steps, enough = [], [], F.lit(True)
    for k in LADDER:
        within = F.col("place") < F.col("n") - need + F.least(F.lit(k), need)
        sums += [
            F.sum(F.when(within, F.col("count") - 1).otherwise(0)).alias(f"_met{k}"),
            F.count(F.when(within, 1)).alias(f"_shared{k}"),
        ]
        matches = F.least(F.lit(k), need)
        steps.append(
            F.struct(
                (F.col(f"_met{k}") * (1 + COMPARISON / matches)).alias("estimate"),
                (-matches).alias("matches"),
                F.col(f"_met{k}").alias("cost"),
            )
        )
        enough = enough & (F.col(f"_shared{k}") >= F.least(F.lit(k), needed(need)))
    counted = places.groupBy("sid", "n").agg(*sums).filter(enough)
    best = counted.select("sid", F.array_min(F.array(*steps)).alias("_best"))
    chosen = durable(
        best.select("sid", (-F.col("_best.matches")).cast("int").alias("matches"), F.col("_best.cost").alias("cost")),
        "chosen",
    )
    rows = places.join(chosen, "sid").filter(F.col("place") < F.col("n") - need + F.col("matches"))
    postings = durable(rows.select("token", "sid", "n", "matches", "cost"), "postings")
    for step in (met, places, chosen):
        forget(step)
    return postings


def _hubs(postings: DataFrame) -> DataFrame:
    """Texts with the hub to compare them with."""
    hubs = postings.groupBy("token").agg(F.max(F.struct("cost", "sid", "n", "matches")).alias("hub"))
    hubs = durable(hubs, "hubs")
    met = postings.join(hubs, "token").filter(
        (F.col("sid") != F.col("hub.sid")) & _alike_in_size(F.col("n"), F.col("hub.n"))
    )
    chosen = durable(_best_hub(met).select("sid", "hub"), "chosen-hubs")
    forget(hubs)
    return chosen


def _best_hub(met: DataFrame) -> DataFrame:
    """For each text the hub that it shares most prefix shingles with. Other texts may be the
    hub of some of the shingles that the two share, so a quarter of the matches is enough."""
    enough = F.least("matches", "hub.matches")
    best = met.groupBy("sid", F.col("hub.sid").alias("hub"), enough.alias("enough")).count()
    best = best.filter("4 * count >= enough")
    return best.groupBy("sid").agg(F.max(F.struct("count", "hub"))["hub"].alias("hub"))


def _compared(sets: DataFrame) -> DataFrame:
    """Each text with its hub: ``hub``, the hub's size, ``u``, and the deviations of texts near
    the hub (null for others)."""
    hubs = sets.filter("leads").select(F.col("sid").alias("hub"), F.col("tokens").alias("_t"))
    led = sets.filter(F.col("hub").isNotNull()).select("sid", "hub", F.col("tokens").alias("_s"))
    both = led.join(hubs, "hub")
    both = both.withColumn("_r", F.array_except("_t", "_s")).withColumn("_a", F.array_except("_s", "_t"))
    both = both.withColumn("u", 5 * F.size("_r") + 4 * F.size("_a")).withColumn("hub_n", F.size("_t"))
    # beyond, a text cannot be similar to one that is similar to the hub
    near = 4 * F.col("u") <= 9 * F.col("hub_n")
    rows = both.select("sid", "hub", "hub_n", "u", F.when(near, F.concat("_r", "_a")).alias("deviations"))
    return durable(rows, "compared")


def _near_hub_links(compared: DataFrame) -> DataFrame:
    """Links of texts near one hub that are not both similar to it.

    A text outside the hub's reach has ``u > |h|``. Its partner shares at least ``(u' + 1) / 9``
    deviations with it, and it shares at least ``(u - |h|) / 9`` with any partner; so each
    meets the other in the first deviations, rarest first, up to its own number less that.
    """
    near = compared.filter(F.col("deviations").isNotNull()).withColumn("outside", F.col("u") > F.col("hub_n"))
    hubs = near.filter("outside").select("hub").distinct()
    rows = near.join(hubs, "hub").select(
        "hub",
        "sid",
        "outside",
        (F.size("deviations") - F.ceil((F.col("u") + 1) / 9) + 1).alias("short"),
        (F.size("deviations") - F.ceil((F.col("u") - F.col("hub_n")) / 9) + 1).alias("long"),
        F.size("deviations").alias("all"),
        F.explode("deviations").alias("token"),
    )
    every = durable(rows, "deviations")
    met = durable(every.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("met")).filter("met > 1"), "met")
    rows = every.join(met, ["hub", "token"])
    own = Window.partitionBy("sid")  # the deviations of one text
    place = F.col("all") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("met", "token"))
    rows = durable(rows.withColumn("place", place).filter("place <= greatest(short, long)"), "first")

    def side(which: str, name: str) -> DataFrame:
        return rows.filter(which).select("hub", "token", F.col("sid").alias(name))

    keys = ["hub", "token"]
    outer = side("outside and place <= short", "a")
    among = outer.join(side("outside and place <= short", "b"), keys).filter("a < b")
    across = side("outside and place <= long", "a").join(side("not outside and place <= short", "b"), keys)
    pairs = among.select("a", "b").union(across.select("a", "b")).distinct()
    a = near.select(F.col("sid").alias("a"), "u", "hub_n", F.col("deviations").alias("_d"))
    b = near.select(F.col("sid").alias("b"), F.col("u").alias("_u"), F.col("deviations").alias("_e"))
    both = pairs.join(a, "a").join(b, "b")
    shared = F.size(F.array_intersect("_d", "_e"))
    links = both.filter(9 * shared >= F.col("u") + F.col("_u") - F.col("hub_n")).select("a", "b")
    links = durable(links, "near-links")
    for step in (every, met, rows):
        forget(step)
    return links


def _rest_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of texts near different hubs that share enough prefix shingles, of postings with their
    texts' groups. For each shingle the group with most texts is met by the others only, never by
    itself."""
    sizes = rows.groupBy("token", "near").count()
    largest = sizes.groupBy("token").agg(
        F.max(F.struct("count", "near"))["near"].alias("largest"), F.count(F.lit(1)).alias("_groups")
    )
    largest = durable(largest.filter("_groups > 1"), "largest")
    rows = durable(rows.join(largest, "token").withColumn("inner", F.col("near") == F.col("largest")), "rest")
    columns = ("sid", "n", "matches", "near", "part")
    other = rows.filter("not inner").select("token", *[F.col(c).alias(c + "_a") for c in columns])
    every = rows.select("token", "inner", *[F.col(c).alias(c + "_b") for c in columns])
    pairs = other.join(every, "token").filter(
        (F.col("near_a") != F.col("near_b"))
        & (F.col("part_a") != F.col("part_b"))
        & (F.col("inner") | (F.col("sid_a") < F.col("sid_b")))
        & _alike_in_size(F.col("n_a"), F.col("n_b"))
    )
    pairs = pairs.select(
        F.least("sid_a", "sid_b").alias("a"),
        F.greatest("sid_a", "sid_b").alias("b"),
        F.least("matches_a", "matches_b").alias("matches"),
    )
    found = pairs.groupBy("a", "b", "matches").count().filter("count >= matches").select("a", "b")
    found = durable(found, "rest-pairs")
    for step in (largest, rows):
        forget(step)
    return found


def _groups(members: DataFrame, compared: DataFrame, linked: DataFrame) -> DataFrame:
    """Members with ``near``, the hub that a text is near to or the text itself, and ``part``:
    what the links with hubs connect."""
    near = compared.filter(F.col("deviations").isNotNull()).select("sid", F.col("hub").alias("near"))
    chain = components(linked).select(F.col("node").alias("sid"), F.col("root").alias("top"))
    rows = members.join(near, "sid", "left").join(chain, "sid", "left")
    return durable(
        rows.select("sid", F.coalesce("near", "sid").alias("near"), F.coalesce("top", "sid").alias("part")),
        "groups",
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key, ``n_shingles``, and ``component_id``, the smallest key
    that links reach."""
    rows = docs.select(F.col(quoted(key)).alias("key"), text_of(text).alias("text"))
    signed = durable(_signed(rows, frequent_shingles(rows)), "signed")
    # what is left of all rows once the prefixes are dealt with
    sizes = durable(signed.select("key", "sid", "n"), "sizes")
    classes = durable(_possible(signed), "classes")
    forget(signed)
    postings = _postings(classes)
    keys = durable(classes.select("sid", "key"), "keys")
    forget(classes)
    members = durable(postings.select("sid").distinct(), "members")
    hubs = _hubs(postings)
    sets = _whole_sets(rows, _wanted(keys, hubs))

    compared = _compared(sets)
    linked = compared.filter("u <= hub_n").select("sid", "hub")
    links = linked.toDF("a", "b").union(_near_hub_links(compared))
    groups = _groups(members, compared, linked)
    grouped = durable(postings.join(groups, "sid"), "grouped")
    for step in (postings, members, hubs, groups):
        forget(step)
    rest = _rest_pairs(grouped)
    forget(grouped)
    # most of these texts had no hub to be compared with
    texts = durable(_texts(rest), "texts")
    other = texts.join(sets.select("sid"), "sid", "left_anti")
    others = _whole_sets(rows, keys.join(other, "sid"))
    both = sets.select("sid", "tokens").join(texts, "sid", "left_semi").union(others)
    roots = components(links.union(_linked(rest, both)))
    for step in (sets, others, compared, rest, texts, keys):
        forget(step)
    # the smallest key of each class; of each component
    least = durable(sizes.filter("n > 0").groupBy("sid").agg(F.min("key").alias("key")), "least")
    named = roots.select(F.col("node").alias("sid"), "root").join(least, "sid")
    joined = named.groupBy("root").agg(F.min("key").alias("component_id"))
    joined = durable(named.join(joined, "root").select("sid", "component_id"), "joined")
    ids = least.join(joined, "sid", "left").select("sid", F.coalesce("component_id", "key").alias("component_id"))
    out = sizes.join(durable(ids, "ids"), "sid", "left")
    own = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller key. A row is told by
    its key; rows that repeat a key and stay are all kept."""
    found = near_duplicates(docs, key, text)
    gone = found.filter(F.col("component_id") < F.col(quoted(key))).select(quoted(key)).distinct()
    return docs.join(durable(gone, "gone"), key, "left_anti")
