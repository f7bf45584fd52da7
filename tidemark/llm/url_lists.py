"""Temporal list join: captures judged by the list entries in force when they were fetched.

A list changes over time: dated entries add and remove patterns. For each list and pattern the
entries become validity intervals (the next entry of the pattern ends the one before). A capture
is looked up by the few patterns that can cover it, namely its address, its host, and its
host's parent domains, and matches the interval that holds its fetch time.

Intervals are written first, so that the join's two sides are plain scans: Spark sends the
intervals to all tasks if they are small, or splits a hot host's captures over several tasks.
Captures are narrow rows; a match adds no page text.

Defined results: entries at one time for one list and pattern count once, a removal before an
addition, so that the pattern is listed. An entry without time, list or pattern is ignored. A
null address or fetch time matches nothing. A capture matches a list once, by its longest
pattern. Rows that repeat each have their result. Empty tables give empty lists or no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import quoted
from tidemark.session import durable

MOST_PARENTS = 126  # a host name has at most 127 labels (fixed by the name system)


def normalised(url: Column) -> Column:
    """Lower-cased host, path and query without scheme, user, port, fragment, ``www.``."""
    bare = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?", "")
    host = F.regexp_replace(
        F.lower(F.regexp_extract(bare, r"^([^/:?#]*)", 1)), r"^www\.|\.$", ""
    )
    rest = F.regexp_replace(F.regexp_extract(bare, r"^[^/:?#]*(?::[0-9]*)?([^#]*)", 1), r"/+$", "")
    return F.concat(host, rest)


def host_of(address: Column) -> Column:
    return F.regexp_extract(address, r"^([^/?]*)", 1)


def patterns(address: Column) -> Column:
    """The address itself, its host, and the host's parent domains of two labels or more."""
    labels = F.split(host_of(address), r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.lit(MOST_PARENTS + 1)), "."),
    )
    return F.array_distinct(F.concat(F.array(address, host_of(address)), parents))


def intervals(entries: DataFrame) -> DataFrame:
    """From (list, pattern, at, listed) the intervals (list, pattern, since, until) in which a
    pattern is listed; ``until`` is null while it still is."""
    known = entries.select("list", "pattern", "at", "listed").dropna()
    states = known.groupBy("list", "pattern", "at").agg(F.max("listed").alias("listed"))
    order = Window.partitionBy("list", "pattern").orderBy("at")
    spans = states.withColumn("until", F.lead("at").over(order))
    return spans.filter("listed").select("list", "pattern", F.col("at").alias("since"), "until")


def judged(
    captures: DataFrame,
    entries: DataFrame,
    key: str = "page_id",
    url: str = "url",
    fetched: str = "fetched",
) -> DataFrame:
    """Every capture with the lists that its address is on at its fetch time, and the patterns
    that put it there. ``entries`` has (list, pattern, at, listed)."""
    spans = durable(intervals(entries), "intervals")
    rows = captures.select(
        F.col(quoted(key)).alias(key),
        F.col(quoted(url)).alias("url"),
        F.col(quoted(fetched)).alias("fetched"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = durable(rows, "captures")  # the row numbers are used twice
    asked = rows.select(
        "_row", "fetched", F.explode(patterns(normalised(F.col("url")))).alias("pattern")
    ).filter(F.col("pattern") != "")
    active = (F.col("fetched") >= F.col("since")) & (
        F.col("until").isNull() | (F.col("fetched") < F.col("until"))
    )
    longest = F.max(F.struct(F.length("pattern").alias("n"), "pattern"))["pattern"]
    hits = asked.join(spans, "pattern").filter(active).groupBy("_row", "list").agg(longest.alias("pattern"))
    lists = F.sort_array(F.collect_list(F.struct("list", "pattern")))
    per_row = hits.groupBy("_row").agg(lists.alias("_hits"))
    out = rows.join(per_row, "_row", "left")
    return out.select(
        key,
        "url",
        "fetched",
        F.coalesce(F.array_join(F.transform("_hits", lambda h: h["list"]), ","), F.lit("")).alias("lists"),
        F.coalesce(F.array_join(F.transform("_hits", lambda h: h["pattern"]), ","), F.lit("")).alias("matched"),
        F.col("_hits").isNotNull().alias("listed"),
    )
