"""Quality rules as weak supervision, in Spark's own expressions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation-maximisation over the
counts of vote patterns estimates, for either class, how often each rule votes good when it votes,
and the share of good documents. A document is kept if its posterior probability of being good is
at least one half, so that one odd figure alone need not remove it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.session import staged

BLANKS = r"[\x20\x09-\x0D]+"
NO_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: A word of letters, with quotes or one mark around it as prose has.
PLAIN = r"^[(\"'\u00AB\u201C]?\p{L}[\p{L}'\u2019-]*[.,;:!?]?[)\"'\u00BB\u201D]?$"
#: Rules in the order of their votes.
RULES = ("symbols", "lines", "repeats", "word_length", "capitals", "sentences", "letters", "plain")
ITERATIONS = 25
#: Rates stay this far from 0 and 1, so that no single vote is beyond doubt.
MARGIN = 1e-3


@dataclass(frozen=True)
class Model:
    """Share of good documents; for each rule, the probability of a good vote in either class."""

    good_share: float
    vote_good_if_good: tuple[float, ...]
    vote_good_if_bad: tuple[float, ...]


#: Where estimation starts: rules are better than chance, and most documents are good.
START = Model(0.8, (0.95,) * len(RULES), (0.5,) * len(RULES))


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts that the rules look at, of every whole text; a null text has none of anything."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select("doc_id", "text", F.array_remove(F.split("text", BLANKS), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NO_BLANK))
    counted = words.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.size(F.filter("words", lambda x: x.rlike(r"\p{L}"))).cast("long").alias("n_lettered"),
        F.size(F.filter("words", lambda x: x.rlike(PLAIN))).cast("long").alias("n_plain"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit(r"\p{L}[.!?](?=[\x20\x09-\x0D]|$)")).cast("long").alias("n_ends"),
        F.expr(
            "sort_array(transform(slice(words, 1, greatest(size(words) - 2, 0)),"
            " (w, i) -> struct(concat_ws(' ', w, get(words, i + 1), get(words, i + 2)) AS words, i AS at)))"
        ).alias("windows"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_lettered", "n_plain", "n_capitals", "n_ends"]
    # Equal windows are neighbours once sorted.
    paired = counted.select(
        "doc_id",
        *counts,
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "sort_array(transform(filter(windows, (x, i) -> get(windows, i - 1).words = x.words OR get(windows, i + 1).words = x.words), x -> x.at))"
        ).alias("places"),
    )
    covered = "aggregate(transform(places, (p, i) -> least(3, coalesce(get(places, i + 1) - p, 3))), 0, (sum, x) -> sum + x)"
    return paired.select("doc_id", *counts, "n_lines", "n_dup_lines", F.expr(covered).cast("long").alias("n_repeat_words"))


def vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("byte")


def votes() -> list[Column]:
    """A column for each rule over the counts of `text_counts`."""
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    some = n > 0
    return [
        vote(some & (10 * F.col("n_symbols") > n), some & (50 * F.col("n_symbols") <= n)).alias("symbols"),
        vote(10 * F.col("n_dup_lines") > 3 * lines, (lines >= 3) & (20 * F.col("n_dup_lines") <= lines)).alias("lines"),
        vote(some & (100 * F.col("n_repeat_words") > 30 * n), some & (100 * F.col("n_repeat_words") <= 15 * n)).alias("repeats"),
        vote(some & ((chars < 2 * n) | (chars > 15 * n)), some & (chars >= 3 * n) & (chars <= 10 * n)).alias("word_length"),
        vote(2 * F.col("n_capitals") > chars, some & (5 * F.col("n_capitals") <= chars)).alias("capitals"),
        vote((n >= 50) & (40 * F.col("n_ends") < n), some & (100 * F.col("n_ends") >= n) & (2 * F.col("n_ends") <= n)).alias("sentences"),
        vote(some & (10 * F.col("n_lettered") < 7 * n), some & (10 * F.col("n_lettered") >= 9 * n)).alias("letters"),
        vote(some & (10 * F.col("n_plain") < 6 * n), some & (10 * F.col("n_plain") >= 9 * n)).alias("plain"),
    ]


def posterior(model: Model) -> Column:
    """Probability that a document with the votes in the columns named by RULES is good."""
    odds = F.lit(0.0)
    for rule, good, bad in zip(RULES, model.vote_good_if_good, model.vote_good_if_bad, strict=True):
        at_good, at_bad = F.log(F.lit(good / bad)), F.log(F.lit((1 - good) / (1 - bad)))
        odds = odds + F.when(F.col(rule) == 1, at_good).when(F.col(rule) == -1, at_bad).otherwise(0.0)
    prior = F.log(F.lit(model.good_share / (1 - model.good_share)))
    return 1 / (1 + F.exp(-(odds + prior)))


def fit(voted: DataFrame, iterations: int = ITERATIONS, start: Model = START) -> Model:
    """Expectation-maximisation over the vote columns; documents with equal votes count as one weighted row.

    There are at most 3 ** len(RULES) such rows whatever the input; what comes to the driver is one
    row of rates for each iteration. An empty table leaves the start as it is.
    """
    patterns = staged(voted.groupBy(*RULES).agg(F.count("*").alias("weight")), "vote-patterns")
    model = start
    clip = lambda x: min(1 - MARGIN, max(MARGIN, x))
    for _ in range(iterations):
        p, w = posterior(model), F.col("weight")
        sums = [F.sum(w).alias("all"), F.sum(w * p).alias("good")]
        for r in RULES:
            for name, share in (("g", p), ("b", 1 - p)):
                sums.append(F.sum(F.when(F.col(r) == 1, w * share).otherwise(0.0)).alias(f"{r}_{name}_up"))
                sums.append(F.sum(F.when(F.col(r) != 0, w * share).otherwise(0.0)).alias(f"{r}_{name}_all"))
        row = patterns.agg(*sums).first()
        if not row["all"]:
            return start
        # One good and one bad vote are added to each rate, so that a rule that never votes says nothing.
        rate = lambda r, c, row=row: clip((row[f"{r}_{c}_up"] + 1) / (row[f"{r}_{c}_all"] + 2))
        model = Model(clip(row["good"] / row["all"]), tuple(rate(r, "g") for r in RULES), tuple(rate(r, "b") for r in RULES))
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, votes, posterior `quality` and `kept` of every document.

    `base_failed`: fewer than 50 words, or more than half of the words in 3-word windows that occur
    twice or more; such a document is not kept and the model is fitted without it. Rows are judged
    each by itself, so repeated rows and repeated or null ids get equal verdicts; a null or empty
    text fails. The counts are stored once in the shared folder.
    """
    counts = text_counts(docs, id_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    voted = staged(counts.select("*", *votes(), failed.alias("base_failed")), "rule-votes")
    model = fit(voted.where(~F.col("base_failed")))
    return voted.withColumn("quality", posterior(model)).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
