"""Chats as training windows of bounded length, with a loss mask.

Turns are written with role marks; control strings inside texts are escaped reversibly. A
conversation longer than the budget becomes several windows. Running sums of the turns' lengths
choose the spans: the running total is cut into strides, the turns that lie within one stride
form a span, and a turn that crosses a border is a span of its own. So spans are whole turns, no
longer than a stride unless a single turn is, and found without a loop over the conversation.
Each window starts with the conversation's opening system turn, then repeats the whole turns before
its span that fit into the room left in the budget, or that begin within ``HISTORY`` tokens before
it where that is more, then has its span. An assistant turn at the start of a span always has the
turn before it. Repeated turns are marked as such, and the mask covers only the assistant texts of
the span, so every target is learnt once.

Everything is window functions and column expressions. A conversation's running sums are made in
one task, which sorts its turns externally; a window, like a digest of a whole conversation, is
one value and must fit into a row.

Defined results: a null text, role or name is an empty one. Turns are ordered by number, nulls
first, then by role and text; rows that repeat are turns of their own. A null conversation
identifier is an identifier like others. Windows exceed the budget where whole turns do not fit:
by a single turn longer than a stride, by an answer whose prompt does not fit beside it, and by an
opening system turn that leaves less than ``budget // 4`` for a stride (over 640 tokens by
default), which each window still has in full. An empty table gives an empty result. Input columns
other than the four are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, quoted, text_of

BUDGET = 1024  # tokens (words and marks) of a window, but for turns that do not fit
HISTORY = 128
MARKS = 4  # tokens that a turn's own marks count

# Control strings of the chat formats in use (fixed values): role marks begin with "<|"; the
# others are those of bracketed instruction formats.
_CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|/?<?/?SYS>)"
_END = "<|end|>\n"


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put behind the first character of a control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    """The inverse: of two backslashes one stays, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _head(role: Column, again: Column) -> Column:
    # a role may hold the end of its own mark
    name = F.regexp_replace(escaped(role), r"\|(?=>)", r"|\\")
    return F.concat(F.lit("<|"), F.when(again, "again ").otherwise("turn "), name, F.lit("|>\n"))


def turns(
    chats: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """The turns with their running sums and the span that each belongs to."""
    rows = chats.select(
        F.col(quoted(conversation)).alias("conv_id"),
        F.col(quoted(turn)).alias("turn"),
        text_of(role).alias("role"),
        text_of(text).alias("text"),
    )
    length = F.regexp_count("text", F.lit(WORD)).cast("long") + MARKS
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("length", length).withColumn("place", F.row_number().over(order))
    rows = rows.withColumn("after", F.sum("length").over(Window.partitionBy("conv_id").orderBy("place")))
    rows = rows.withColumn("before", F.col("after") - F.col("length"))
    opening = (F.col("place") == 1) & (F.col("role") == "system")
    # what the opening system turn and the history may take is kept free in each window
    ahead = F.max(F.when(opening, F.col("length"))).over(Window.partitionBy("conv_id"))
    stride = F.greatest(F.lit(budget - history) - F.coalesce(ahead, F.lit(0)), F.lit(budget // 4))
    rows = rows.withColumn("opening", opening).withColumn("_stride", stride)
    first = F.floor(F.col("before") / F.col("_stride"))
    last = F.floor((F.col("after") - 1) / F.col("_stride"))
    rows = rows.withColumn("_cut", F.struct(first.alias("a"), last.alias("b"))).drop("_stride")
    previous = F.lag("_cut").over(Window.partitionBy("conv_id").orderBy("place"))
    return rows.withColumn("starts", ~F.col("_cut").eqNullSafe(previous)).drop("_cut")


def windows(
    chats: DataFrame, budget: int = BUDGET, history: int = HISTORY, **options
) -> DataFrame:
    """One row per window: ``conv_id``, ``window``, ``formatted``, and ``loss``, an array of
    (start, length) in code points of ``formatted``."""
    rows = turns(chats, budget=budget, history=history, **options)
    by_place = Window.partitionBy("conv_id").orderBy("place")
    rows = rows.withColumn("window", F.sum(F.col("starts").cast("int")).over(by_place))
    again = _piece(F.lit(True))
    own = F.max("after").over(Window.partitionBy("conv_id", "window")) - F.col("before")
    opening = F.max(F.when(F.col("opening"), F.col("length"))).over(Window.partitionBy("conv_id"))
    room = F.greatest(F.lit(history), F.lit(budget) - F.coalesce(opening, F.lit(0)) - own)
    # where a repeated turn may begin, at a span's first turn
    rows = rows.withColumn("_from", F.col("before") - room)
    earlier = F.struct(F.col("before").alias("at"), again.alias("piece"), F.col("opening").alias("opening"))
    recent = Window.partitionBy("conv_id").orderBy("before").rangeBetween(-max(budget, history), -1)
    system = F.first(F.when(F.col("opening"), again), ignorenulls=True).over(
        by_place.rowsBetween(Window.unboundedPreceding, -1)
    )
    repeated = F.collect_list(F.when(~F.col("opening"), earlier)).over(recent)
    rows = rows.withColumn("_system", system).withColumn("_recent", repeated)
    rows = rows.withColumn("_previous", F.lag(earlier).over(by_place))
    fits = F.filter("_recent", lambda x: x["at"] >= F.col("_from"))
    prompt = F.when(
        (F.col("role") == "assistant") & ~F.col("_previous.opening") & (F.col("_previous.at") < F.col("_from")),
        F.col("_previous.piece"),
    )
    ahead = F.concat(
        F.coalesce(F.col("_system"), F.lit("")),
        F.coalesce(prompt, F.lit("")),
        F.array_join(F.transform(fits, lambda x: x["piece"]), ""),
    )
    rows = rows.select(
        "conv_id",
        "window",
        "place",
        F.when(F.col("starts"), ahead).otherwise("").alias("_ahead"),
        _head(F.col("role"), F.lit(False)).alias("_head"),
        escaped(F.col("text")).alias("_body"),
        (F.col("role") == "assistant").alias("_target"),
    )
    parts = F.sort_array(F.collect_list(F.struct("place", "_ahead", "_head", "_body", "_target")))
    grouped = rows.groupBy("conv_id", "window").agg(parts.alias("_p"))
    piece = lambda p: F.concat(p["_ahead"], p["_head"], p["_body"], F.lit(_END))
    sizes = F.transform("_p", lambda p: F.length(piece(p)))
    grouped = grouped.withColumn("formatted", F.array_join(F.transform("_p", piece), "")).withColumn("_sizes", sizes)
    start = F.aggregate(
        "_sizes",
        F.array(F.lit(0)),
        lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)),
    )
    grouped = grouped.withColumn("_starts", start)
    spans = F.transform(
        "_p",
        lambda p, i: F.struct(
            (F.get("_starts", i) + F.length(p["_ahead"]) + F.length(p["_head"])).alias("start"),
            F.length(p["_body"]).alias("length"),
            p["_target"].alias("target"),
        ),
    )
    loss = F.transform(
        F.filter(spans, lambda s: s["target"]), lambda s: F.struct(s["start"], s["length"])
    )
    return grouped.select("conv_id", "window", "formatted", loss.alias("loss"))


def _piece(again: Column) -> Column:
    return F.concat(_head(F.col("role"), again), escaped(F.col("text")), F.lit(_END))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: the turns that are not repeated, in order, as
    (role, text), and the texts under the loss mask."""
    own = r"(?s)<\|turn (.*?)\|>\n(.*?)<\|end\|>\n"
    # repeated turns are taken out first: no text can contain a mark
    plain = F.regexp_replace("formatted", r"(?s)<\|again .*?\|>\n.*?<\|end\|>\n", "")
    roles = F.transform(F.regexp_extract_all(plain, F.lit(own), F.lit(1)), unescaped)
    texts = F.transform(F.regexp_extract_all(plain, F.lit(own), F.lit(2)), unescaped)
    masked = F.transform(
        "loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
    )
    rows = formatted.select(
        "conv_id",
        F.struct(
            F.col("window"),
            F.arrays_zip(roles.alias("role"), texts.alias("text")).alias("turns"),
            masked.alias("targets"),
            F.length("formatted").alias("chars"),
        ).alias("_w"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_w")).alias("_w"))
    return grouped.select(
        "conv_id",
        F.flatten(F.transform("_w", lambda w: w["turns"])).alias("turns"),
        F.flatten(F.transform("_w", lambda w: w["targets"])).alias("targets"),
        F.aggregate("_w", F.lit(0).cast("long"), lambda a, w: a + w["chars"]).alias("formatted_chars"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: number and digest of its turns, size and digest of the text under the
    mask, and the size of all windows."""
    rows = read_back(formatted)
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    target = F.array_join("targets", "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"),
        F.sha2(target, 256).alias("loss_sha256"),
        "formatted_chars",
    )
