"""Slowly changing dimensions, types 0 to 3.

All of them compute a new snapshot from the old one; writing it is left to the sinks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.numbers import ladder
from tidemark.functions.text import label
from tidemark.operators.ordered import dense_sequence
from tidemark.operators.rows import first_per_key, last_per_key
from tidemark.session import durable

START, END, CURRENT = "effective_start_date", "effective_end_date", "is_current_flag"
OPEN_END = "9999-12-31"


class Version(NamedTuple):
    """One planned version of a member: tier, credit limit and validity."""

    tier: str
    limit: int
    start: str
    end: str = OPEN_END


class Tier(NamedTuple):
    """A tier, the spend it needs and the versions a member went through to reach it."""

    name: str
    from_spend: float
    versions: tuple[Version, ...]

    @property
    def current(self) -> Version:
        return self.versions[-1]

    @property
    def previous(self) -> Version | None:
        return self.versions[-2] if len(self.versions) > 1 else None


def retain_original(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Type 0: keep what is there; of new keys take the first incoming row."""
    first = first_per_key(incoming, keys, order)
    return existing.unionByName(
        first.select(*existing.columns).join(existing.select(*keys), list(keys), "left_anti")
    )


def overwrite_current(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Type 1: the newest incoming row replaces the existing one; others stay."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(
        incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    return last_per_key(both, keys, ["_new", *order]).select(*existing.columns)


def tier_columns(spend: Column, tiers: Sequence[Tier], names: tuple[str, str, str]) -> dict[str, Column]:
    """Tier, limit and date of the highest tier that the spend reaches. ``tiers`` is
    ordered from the highest; the last one takes everybody, null spend included."""
    value = F.coalesce(spend, F.lit(0))
    *upper, base = tiers
    pick = lambda field: ladder(
        value, [(t.from_spend, getattr(t.current, field)) for t in upper], getattr(base.current, field)
    )
    return {n: pick(f) for n, f in zip(names, ("tier", "limit", "start"), strict=True)}


def planned_versions(df: DataFrame, final_tier: str, tiers: Sequence[Tier]) -> DataFrame:
    """Type 2 from a final tier: one row per version on the way to it.

    The schedule is a literal, so the table is read once and no join is needed.
    """
    def rows(tier: Tier) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(v.tier).alias("loyalty_tier"),
                    F.lit(v.limit).alias("credit_limit_usd"),
                    F.lit(v.start).cast("date").alias(START),
                    F.lit(v.end).cast("date").alias(END),
                    F.lit(v.end == OPEN_END).alias(CURRENT),
                )
                for v in tier.versions
            ]
        )

    schedule = F.create_map(*[x for t in tiers for x in (F.lit(t.name), rows(t))])
    exploded = df.withColumn("_v", F.explode(F.element_at(schedule, F.col(final_tier))))
    return exploded.drop(final_tier).select("*", "_v.*").drop("_v")


def version_keys(
    versions: DataFrame,
    keys: Sequence[str],
    name: str = "customer_sk",
    prefix: str = "CUST_SK_",
    width: int = 4,
    first: int = 1,
    start: str = START,
) -> DataFrame:
    """Number the versions by key and start date."""
    numbered = dense_sequence(versions, [*keys, start], "_n", first)
    return numbered.select(label(prefix, F.col("_n"), width).alias(name), *versions.columns)


def version_order(versions: DataFrame, keys: Sequence[str], start: str = START) -> DataFrame:
    """The versions in the order they are published in: by key and start date. Written as a
    table, the files hold them in this order."""
    return versions.orderBy(*keys, start)


def apply_changes(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
    order: Sequence[str],
    surrogate: str | None = None,
    prefix: str = "CUST_SK_",
    width: int = 4,
) -> DataFrame:
    """Type 2, incremental: close the open version the day before a change takes effect
    and open a new one. The result has the columns of ``dim``.

    Several changes of a key on one day count as the last one by ``order``. A state equal
    to the one before makes no version. A change older than the open version rebuilds the
    key's timeline from all its stored versions. New surrogate keys go on from the highest
    one; a version that stays keeps its own. Versions of keys without a change are passed
    through: they are neither sorted nor written.

    Columns of ``dim`` that are not tracked take their value from the change, where it has one,
    else the last one known; a stored version keeps its own.

    Changes are reduced to one per key and day before anything is sorted, so the timeline
    of a key is no longer than the calendar, however often it changed.
    """
    keys, tracked, order = list(keys), list(tracked), list(order)
    if not order:
        raise ValueError("changes of one day need an order")
    known = {*keys, *tracked, START, END, CURRENT, surrogate}
    others = [f for f in dim.schema.fields if f.name not in known]
    state = F.struct(*tracked)
    number = F.col(surrogate) if surrogate else F.lit(None).cast("string")

    def carried(rows: DataFrame) -> Column:
        return F.struct(
            F.lit(None).alias("_"),
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in others
            ],
        )

    def stored(rows: DataFrame) -> DataFrame:
        return rows.select(
            *keys, F.col(START).alias("_start"), state.alias("_state"), carried(rows).alias("_more"), number.alias("_sk")
        )

    last = F.max_by(F.struct(state.alias("state"), carried(changes).alias("more")), F.struct(*order))
    fresh = changes.groupBy(*keys, F.col(effective).cast("date").alias("_start")).agg(last.alias("_last"))
    fresh = fresh.select(*keys, "_start", F.col("_last.state").alias("_state"), F.col("_last.more").alias("_more"))
    earliest = fresh.groupBy(*keys).agg(F.min("_start").alias("_first"))
    touched = dim.join(earliest, keys)
    late = touched.filter(F.col(CURRENT) & (F.col("_first") < F.col(START))).select(*keys)
    closed = touched.filter(~F.col(CURRENT)).drop("_first")
    rebuilt = stored(closed.join(late, keys, "left_semi"))
    untouched = dim.join(earliest, keys, "left_anti").unionByName(closed.join(late, keys, "left_anti"))

    timeline = (
        stored(touched.filter(CURRENT)).unionByName(rebuilt)
        .withColumn("_fresh", F.lit(0))
        .unionByName(fresh.withColumns({"_sk": F.lit(None).cast("string"), "_fresh": F.lit(1)}))
        # a change on the day a version began replaces the state of that version
        .groupBy(*keys, "_start")
        .agg(
            F.max_by("_state", "_fresh").alias("_state"),
            F.max("_sk").alias("_sk"),
            F.max("_fresh").alias("_fresh"),
            *[
                F.max_by(value, F.when(value.isNotNull(), F.col("_fresh"))).alias(name)
                for name, value in ((f"_more_{f.name}", F.col("_more").getField(f.name)) for f in others)
            ],
        )
    )
    window = Window.partitionBy(*keys).orderBy("_start")
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def value_of(name: str) -> Column:
        own = F.col(f"`_more_{name}`")
        return F.when(F.col("_fresh") == 1, F.last(own, ignorenulls=True).over(so_far)).otherwise(own)

    timeline = timeline.withColumns({f"_now_{f.name}": value_of(f.name) for f in others}) if others else timeline
    kept = timeline.withColumn("_before", F.lag("_state").over(window)).filter(
        ~F.col("_state").eqNullSafe(F.col("_before"))
    )
    following = F.lead("_start").over(window)
    versions = kept.select(
        *keys,
        *[F.col(f"_state.{c}").alias(c) for c in tracked],
        *[F.col(f"`_now_{f.name}`").alias(f.name) for f in others],
        F.col("_start").alias(START),
        F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END).cast("date")).alias(END),
        following.isNull().alias(CURRENT),
        F.col("_sk"),
    )
    if surrogate:
        versions = durable(versions, "versions")
        digits = F.regexp_extract(F.col(surrogate), r"(\d+)$", 1).try_cast("long")
        highest = dim.agg(F.max(digits)).first()[0] or 0
        made = version_keys(
            versions.filter(F.col("_sk").isNull()).drop("_sk"), keys, surrogate, prefix, width, highest + 1
        )
        had = versions.filter(F.col("_sk").isNotNull()).withColumnRenamed("_sk", surrogate)
        versions = had.unionByName(made)
    else:
        versions = versions.drop("_sk")
    return untouched.unionByName(versions)


def history_of(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
    order: Sequence[str],
    surrogate: str | None = None,
    others: Sequence[str] = (),
) -> DataFrame:
    """Type 2 from nothing: the whole history that a change feed describes, with ``others`` as
    columns that make no version."""
    empty = changes.limit(0).select(
        *([F.lit("").alias(surrogate)] if surrogate else []),
        *keys,
        *tracked,
        *others,
        F.col(effective).cast("date").alias(START),
        F.col(effective).cast("date").alias(END),
        F.lit(True).alias(CURRENT),
    )
    return apply_changes(empty, changes, keys, tracked, effective, order, surrogate)


def with_previous_tier(dim: DataFrame, tiers: Sequence[Tier], tier: str = "loyalty_tier") -> DataFrame:
    """Type 3 from type 1: tier, limit and date of the change that led to the current tier."""
    def pick(value) -> Column:
        out = F.lit(None)
        for t in tiers:
            if t.previous:
                out = F.when(F.col(tier) == t.name, F.lit(value(t))).otherwise(out)
        return out

    return dim.withColumns(
        {
            "previous_loyalty_tier": pick(lambda t: t.previous.tier).cast("string"),
            "previous_credit_limit_usd": pick(lambda t: t.previous.limit).cast("int"),
            "tier_change_date": pick(lambda t: t.current.start).cast("date"),
        }
    )


def shift_previous(
    dim: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    pairs: Mapping[str, str],
    change_date: str,
    effective: str,
    only_changed: bool = True,
) -> DataFrame:
    """Type 3, incremental: previous := current, current := new, in one step.

    ``pairs`` maps current to previous columns; ``updates`` has one row per key with the
    current columns' new values and the ``effective`` date. Unless ``only_changed`` is
    off, an update that changes nothing leaves the row alone.
    """
    new = updates.select(
        *keys, *[F.col(c).alias(f"_{c}") for c in pairs], F.col(effective).alias("_effective"),
        F.lit(True).alias("_hit"),
    )
    joined = dim.join(new, list(keys), "left")
    shift = F.col("_hit").isNotNull()
    if only_changed:
        differs = F.lit(False)
        for c in pairs:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
        shift = shift & differs
    values: dict[str, Column] = {}
    for current, previous in pairs.items():
        values[previous] = F.when(shift, F.col(current)).otherwise(F.col(previous))
        values[current] = F.when(shift, F.col(f"_{current}")).otherwise(F.col(current))
    values[change_date] = F.when(shift, F.col("_effective")).otherwise(F.col(change_date))
    return joined.withColumns(values).select(*dim.columns)


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(CURRENT)


def as_of(dim: DataFrame, date: Any) -> DataFrame:
    """The versions valid on a day, both ends included."""
    return dim.filter(F.lit(date).cast("date").between(F.col(START), F.col(END)))


def point_in_time(dim: DataFrame, key: str, value: Any, date: Any) -> DataFrame:
    """The version of one member on a day: one row, or none."""
    return as_of(dim.filter(F.col(key) == F.lit(value)), date).limit(1)


def temporal_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    date: str,
    columns: Sequence[str],
    dim_key: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Each fact with the version of its member that was valid on the fact's date.

    An equi-join on the key with the interval as a further condition, never a bare range
    join. ``dim`` should be a stored table: then AQE splits the facts of a hot member, or
    broadcasts the dimension when it is small.
    """
    side = dim.select(
        F.col(dim_key or key).alias("_key"), F.col(START).alias("_from"), F.col(END).alias("_to"), *columns
    )
    match = (F.col(key) == F.col("_key")) & F.col(date).cast("date").between(F.col("_from"), F.col("_to"))
    return facts.join(side, match, how).drop("_key", "_from", "_to")
