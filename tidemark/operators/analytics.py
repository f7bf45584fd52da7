"""Analytical queries over facts and dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.numbers import round_away, round_even
from tidemark.operators.ordered import grouped_median, tile_ends, tile_in
from tidemark.session import durable


def order_totals(
    lines: DataFrame, order_id: str, amount: str, discount: str, name: str = "order_total"
) -> DataFrame:
    """Net amount per order, rounded to cents. ``amount`` is an SQL expression for the
    line value before discount. Decimal sums do not depend on the order of the rows."""
    net = F.expr(f"CAST({amount} AS DECIMAL(18,2))") * (
        F.lit(1).cast("decimal(3,0)") - F.expr(f"CAST({discount} AS DECIMAL(6,2))")
    )
    return lines.groupBy(order_id).agg(
        round_away(F.sum(net), 2).cast("decimal(20,2)").alias(name)
    )


def lifetime_spend(
    orders: DataFrame,
    lines: DataFrame,
    customer: str,
    order_id: str,
    line_order_id: str,
    amount: str,
    discount: str,
    name: str = "lifetime_spend",
) -> DataFrame:
    """Spend per customer. Lines are summed per order before the join, so the join moves
    one row per order, and the totals per customer are summed map-side first."""
    totals = order_totals(lines, line_order_id, amount, discount, "_total")
    joined = orders.select(customer, order_id).join(
        totals, F.col(order_id) == F.col(line_order_id), "inner"
    )
    return joined.groupBy(customer).agg(
        round_away(F.sum("_total"), 2).cast("decimal(20,2)").alias(name)
    )


def star_summary(
    dim: DataFrame,
    facts: DataFrame,
    measures: DataFrame,
    group: str,
    member: str,
    fact_member: str,
    fact: str,
    measure_fact: str,
    value: str,
) -> DataFrame:
    """Members, facts, mean (1 digit) and maximum of a measure by a member attribute.

    Says the same as ``dim LEFT JOIN facts LEFT JOIN measures GROUP BY group``, in which a
    fact counts once per measure, but sums up below both joins: the joins carry one row
    per fact and per member.
    """
    per_fact = measures.groupBy(F.col(measure_fact).alias("_fact")).agg(
        F.count("*").alias("_rows"),
        F.count(value).alias("_n"),
        F.sum(value).alias("_sum"),
        F.max(value).alias("_max"),
    )
    per_member = (
        facts.select(F.col(fact_member).alias("_member"), F.col(fact).alias("_id"))
        .join(per_fact, F.col("_id") == F.col("_fact"), "left")
        .groupBy("_member")
        .agg(
            F.sum(F.when(F.col("_id").isNotNull(), F.coalesce("_rows", F.lit(1)))).alias("_rows"),
            F.sum("_n").alias("_n"),
            F.sum("_sum").alias("_sum"),
            F.max("_max").alias("_max"),
        )
    )
    return (
        dim.select(group, member)
        .join(per_member, F.col(member) == F.col("_member"), "left")
        .groupBy(group)
        .agg(
            F.count_distinct(member).alias("total_companies"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_articles"),
            round_away(F.try_divide(F.sum("_sum"), F.sum("_n")).cast("double"), 1).alias("avg_arr_usd_M"),
            F.max("_max").alias("max_arr_usd_M"),
        )
    )


def peak_by_member(
    observations: DataFrame, dim: DataFrame, key: str, name: str, metric: str, k: int
) -> DataFrame:
    """The ``k`` members with the highest peak; the join carries one row per member."""
    peaks = observations.groupBy(key).agg(F.max(metric).alias("_peak"))
    named = peaks.join(dim.select(key, name), key, "inner")
    return (
        named.groupBy(name)
        .agg(F.max("_peak").alias("peak"))
        .orderBy(F.desc_nulls_last("peak"), name)
        .limit(k)
    )


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), column)
    )


def profile(
    df: DataFrame,
    by: str,
    counts: Mapping[str, str],
    distinct: Mapping[str, str],
    means: Mapping[str, tuple[str, int]],
    maxima: Mapping[str, str] | None = None,
    minima: Mapping[str, str] | None = None,
    medians: Mapping[str, str] | None = None,
) -> DataFrame:
    """Group profile; each mapping is ``output name -> column`` (``means`` adds the digits,
    rounded half to even). Rows without a group are left out. Medians are exact."""
    rows = df.filter(F.col(by).isNotNull())
    out = rows.groupBy(by).agg(
        *[F.count(c).alias(n) for n, c in counts.items()],
        *[F.count_distinct(c).alias(n) for n, c in distinct.items()],
        *[round_even(F.avg(c), d).alias(n) for n, (c, d) in means.items()],
        *[F.max(c).alias(n) for n, c in (maxima or {}).items()],
        *[F.min(c).alias(n) for n, c in (minima or {}).items()],
    )
    for name, column in (medians or {}).items():
        out = out.join(grouped_median(rows, [by], column, name), by, "left")
    return out


def period_growth(
    rollup: DataFrame, key: str, period: Sequence[str], value: str, digits: int = 2
) -> DataFrame:
    """Previous value and growth in percent, per member from period to period.

    The rollup holds one row per member and period, so a window partition is as long as
    the calendar, whatever the number of facts behind it.
    """
    previous = F.lag(value).over(Window.partitionBy(key).orderBy(*period))
    with_previous = rollup.withColumn("previous_value", previous)
    change = F.try_divide(
        (F.col(value) - F.col("previous_value")).cast("double") * 100, F.col("previous_value")
    )
    return with_previous.withColumn("growth_pct", round_away(change, digits))


# The segments in the order they are tried, as SQL over the three scores.
RFM_SEGMENTS = (
    ("r_score >= 3 AND f_score >= 3 AND m_score >= 3", "Champions"),
    ("r_score >= 3 AND f_score >= 2 AND m_score >= 2", "Loyal Customers"),
    ("r_score >= 3", "Recent Customers"),
    ("r_score = 1 AND f_score >= 3 AND m_score >= 3", "At Risk - High Spenders"),
    ("r_score = 1 AND f_score <= 2 AND m_score = 1", "Lost Customers"),
)
RFM_OTHER = "Promising / Needs Attention"


def rfm_metrics(
    orders: DataFrame,
    customer: str,
    order_id: str,
    date: str,
    amount: str,
    snapshot: dt.date | None = None,
) -> DataFrame:
    """Recency in days, number of orders and total spend per customer, as a written table.

    The snapshot defaults to the day after the last order (one value, fetched here). The orders
    are read once.
    """
    spent = orders.groupBy(customer).agg(
        F.max(F.col(date).cast("date")).alias("_last"),
        F.count_distinct(order_id).alias("frequency_orders_count"),
        F.sum(amount).alias("monetary_total_spend"),
    )
    spent = durable(spent, "spent")
    if snapshot is None:
        last = spent.agg(F.max("_last")).first()[0]
        snapshot = (last or dt.date(1970, 1, 1)) + dt.timedelta(days=1)
    return spent.filter(F.col(customer).isNotNull()).select(
        customer,
        F.datediff(F.lit(snapshot), "_last").cast("long").alias("recency_days"),
        "frequency_orders_count",
        "monetary_total_spend",
    )


def rfm_scores(metrics: DataFrame, customer: str, tiles: int = 4) -> DataFrame:
    """Quartile scores by cluster-wide rank, ties by customer.

    ``metrics`` has one row per customer and is read several times, so it should be a written
    table. It is neither sorted nor shuffled: the last row of each quartile is found by
    selection, and every row is compared with these.
    """
    scores = {
        "r_score": ("recency_days", True),
        "f_score": ("frequency_orders_count", False),
        "m_score": ("monetary_total_spend", False),
    }
    orders = {score: [column, customer] for score, (column, _) in scores.items()}
    ends = tile_ends(metrics, orders, tiles)
    out = metrics
    for score, (_, invert) in scores.items():
        tile = tile_in(metrics, orders[score], ends[score])
        out = out.withColumn(score, F.lit(tiles + 1) - tile if invert else tile)
    combined = F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score")
    return out.withColumn("rfm_combined_score", combined)


def rfm_segments(scored: DataFrame) -> DataFrame:
    segment = None
    for test, name in RFM_SEGMENTS:
        hit = F.expr(test)
        segment = F.when(hit, F.lit(name)) if segment is None else segment.when(hit, F.lit(name))
    return scored.withColumn("customer_segment", segment.otherwise(F.lit(RFM_OTHER)))
