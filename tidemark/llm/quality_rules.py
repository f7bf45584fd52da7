"""Quality by weak supervision: rules vote or abstain, expectation maximisation weighs them.

Each rule votes good (1), bad (0) or abstains (null) on a document. A document is truly good
or bad, which nobody tells; every rule has two accuracies, one on good and one on bad
documents. Expectation maximisation finds the accuracies and the share of good documents that
explain the votes best, and the posterior probability that a document is good decides, instead
of a filter that all rules must pass.

Votes are counted per combination first (at most ``3 ** rules`` rows), so that the iterations
work on a few numbers whatever the size of the corpus. There is no shuffle of texts, and texts
are read once. Everything on the rows is a column expression.

Defined results: a null text is an empty one. An empty or blank text has no words; the rules
on shares abstain and the base check fails it. Equal texts get equal results, each row its
own. An empty table gives an empty result. Input columns whose names equal a result column are
replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, SPACE, WORD, carried, quoted, text_of, unpacked
from tidemark.session import durable

MEASURES = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()

#: Frequent function words of the languages served; prose has them, lists and junk do not.
FUNCTION_WORDS = tuple(
    (
        "the of and to in is that it for on with as was are be by this from or an at not "
        "der die das und ist von zu den mit im ein eine für auf dem nicht sich des auch "
        "le la les et de est un une des du que pour dans en au par sur avec pas qui "
        "el los las y es una del por con para se no su al lo como más"
    ).split()
)


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, bad where ``bad`` holds, else abstains."""

    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(self.bad, F.lit(0)).when(self.good, F.lit(1))


def _share(part: str, whole: str) -> Column:
    """Null, so an abstention, where there is nothing to divide by."""
    return F.col(part) / F.nullif(F.col(whole), F.lit(0))


def default_rules() -> list[Rule]:
    """Rules over the measures of ``measured``."""
    symbols, marks = _share("n_symbols", "n_words"), _share("n_marks", "n_words")
    capitals, known = _share("n_capitals", "word_chars"), _share("n_function", "n_words")
    length, twice = _share("word_chars", "n_words"), _share("n_dup_lines", "n_lines")
    repeats = _share("n_repeat_words", "n_words")
    return [
        Rule("symbols", symbols < 0.02, symbols > 0.1),
        Rule("marks", marks < 0.4, marks > 0.8),
        Rule("capitals", capitals < 0.12, capitals > 0.3),
        Rule("function_words", known > 0.08, known < 0.02),
        Rule("word_length", length.between(3, 9), (length < 2) | (length > 14)),
        Rule("repeated_lines", twice < 0.1, twice > 0.3),
        Rule("repeated_words", repeats < 0.15, repeats > 0.4),
        Rule("length", F.col("n_words") >= 80, F.col("n_words") < 20),
    ]


def _left(text: str, pattern: str) -> Column:
    """Code points of the text that are left without the pattern."""
    return F.length(F.regexp_replace(text, pattern, ""))


def measured(df: DataFrame, text: str = "_text") -> DataFrame:
    """Add the measures of a non-null text column; arrays live within a row only.

    ``n_repeat_words`` counts words inside a window of three words that occurs twice or more:
    windows are hashed, sorted together with their place, equal neighbours are marked, and the
    marked windows' union is measured by the gaps between their places. Texts without any
    repetition, found by a linear check, skip the sort.
    """
    rows = df.withColumn("_words", F.filter(F.split(text, SPACE, -1), lambda w: w != ""))
    rows = rows.withColumn(
        "_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    ).withColumn("n_words", F.size("_words").cast("long"))
    windows = F.transform(
        F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.size("_words") - 3)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.xxhash64(
            F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)
        ),
    )
    rows = rows.select(
        "*",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(text) - _left(text, r"[#*$%&|<>]+")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _left(text, r"[\p{L}\p{N}\p{M}\s]+").alias("n_marks"),
        (F.length(text) - _left(text, r"\p{Lu}+")).alias("n_capitals"),
        F.size(F.filter("_words", lambda w: w.isin(*FUNCTION_WORDS))).alias("n_function"),
        windows.alias("_windows"),
    ).drop("_words", "_lines")
    rows = rows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("_windows")

    def same(e: Column, k: Column) -> Column:
        return F.coalesce(F.get("_sorted", k)["h"] == e["h"], F.lit(False))

    marked = F.filter("_sorted", lambda e, k: same(e, k - 1) | same(e, k + 1))
    rows = rows.withColumn("_places", F.sort_array(F.transform(marked, lambda e: e["i"])))
    covered = F.aggregate(
        F.transform(
            "_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - p, F.lit(3)))
        ),
        F.lit(0),
        lambda a, n: a + n,
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_sorted", "_places"
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Model:
    """Share of good documents, and per rule the probabilities that it votes good on a good
    document and bad on a bad one, given that it votes."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def log_odds(self, votes: Sequence[int | None]) -> float:
        total = _logit(self.prior)
        for v, g, b in zip(votes, self.on_good, self.on_bad):
            if v == 1:
                total += math.log(g) - math.log(1 - b)
            elif v == 0:
                total += math.log(1 - g) - math.log(b)
        return total

    def posterior(self, votes: Sequence[Column]) -> Column:
        total = F.lit(_logit(self.prior))
        for v, g, b in zip(votes, self.on_good, self.on_bad):
            good, bad = math.log(g) - math.log(1 - b), math.log(1 - g) - math.log(b)
            total = total + F.when(v == 1, good).when(v == 0, bad).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _logit(p: float) -> float:
    return math.log(p) - math.log(1 - p)


def estimate(
    patterns: Mapping[tuple, int],
    rules: int,
    start: float = 0.9,
    accuracy: float = 0.8,
    rounds: int = 200,
    tolerance: float = 1e-9,
) -> Model:
    """Expectation maximisation over counted vote combinations.

    The start says that rules are mostly right, which decides which of the two classes is the
    good one. Each accuracy is smoothed by one right and one wrong vote.
    """
    model = Model(start, (accuracy,) * rules, (accuracy,) * rules)
    total = sum(patterns.values())
    if not total:
        return model
    ordered = sorted(patterns.items(), key=repr)
    for _ in range(rounds):
        good = 0.0
        counts = [[1.0, 2.0, 1.0, 2.0] for _ in range(rules)]  # right and all votes, by class
        for votes, n in ordered:
            odds = model.log_odds(votes)
            p = 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0
            good += n * p
            for v, c in zip(votes, counts):
                if v is not None:
                    c[0] += n * p * v
                    c[1] += n * p
                    c[2] += n * (1 - p) * (1 - v)
                    c[3] += n * (1 - p)
        new = Model(
            (good + 1) / (total + 2),
            tuple(c[0] / c[1] for c in counts),
            tuple(c[2] / c[3] for c in counts),
        )
        moved = max(
            abs(a - b)
            for a, b in zip(
                (new.prior, *new.on_good, *new.on_bad), (model.prior, *model.on_good, *model.on_bad)
            )
        )
        model = new
        if moved < tolerance:
            break
    return model


def fit(voted: DataFrame, rules: Sequence[Rule]) -> Model:
    """The model of a table that has a vote column ``_vote_<rule>`` for each rule, fitted on
    the rows that pass the base check: very short and repetitive texts make rules fail together,
    which would turn the two classes into short and long. The driver sees one row per
    combination of votes, ``3 ** rules`` at most."""
    names = [f"_vote_{r.name}" for r in rules]
    counted = voted.filter(~base_failed()).groupBy(*names).count().collect()
    return estimate({tuple(r)[:-1]: r["count"] for r in counted}, len(rules))


def _voted(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Measures and votes next to the carried row, written once, because the votes of all
    rows are counted before any row can be judged."""
    votes = [r.vote().cast("int").alias(f"_vote_{r.name}") for r in rules]
    return durable(measured(rows).select(ROW, *MEASURES, *votes), "voted")


def judged(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    rules: Sequence[Rule] | None = None,
    cut: float = 0.5,
) -> DataFrame:
    """All rows with their measures, ``base_failed``, the ``posterior`` probability of being
    good, and ``kept``. ``keep`` names the input columns wanted next to the result (all of them
    if left out); only those are written in between."""
    rules = default_rules() if rules is None else list(rules)
    wanted = docs.columns if keep is None else keep
    row = F.struct(*[F.col(quoted(c)) for c in wanted]).alias(ROW)
    voted = _voted(docs.select(row, text_of(text).alias("_text")), rules)
    posterior = fit(voted, rules).posterior([F.col(f"_vote_{r.name}") for r in rules])
    out = voted.withColumn("posterior", posterior).withColumn("base_failed", base_failed())
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= cut))
    return unpacked(out, *MEASURES, "base_failed", "posterior", "kept")


def good_documents(docs: DataFrame, text: str = "text", cut: float = 0.5) -> DataFrame:
    """The rows that are kept, with their input columns only. Texts are measured twice, for the
    counts of votes and for the verdicts, and no row is written in between."""
    rules = default_rules()
    names = [f"_vote_{r.name}" for r in rules]
    votes = [r.vote().cast("int").alias(n) for r, n in zip(rules, names)]

    def passed(rows: DataFrame, *kept: str) -> DataFrame:
        # a filter is not pushed below a row number, which would compute the measures in it anew
        made = measured(rows).select(*kept, *MEASURES, *votes, F.monotonically_increasing_id().alias("_at"))
        return made.filter(~base_failed() & (F.col("_at") >= 0))

    texts = docs.select(text_of(text).alias("_text"))
    posterior = fit(passed(texts), rules).posterior([F.col(n) for n in names])
    rows = passed(carried(docs, _text=text_of(text)), ROW)
    return unpacked(rows.filter((posterior >= cut) & (F.col("_at") >= 0)))
