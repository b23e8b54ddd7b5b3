"""Quality of documents by weak supervision: rules vote or abstain, EM weighs the votes.

Main path: DataFrame functions only. What reaches the driver are the counts of vote patterns, at
most ``3 ** len(RULES)`` rows whatever the corpus holds.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.columns import whole, words
from pagewright.session import stage

SYMBOLS = "[#*$%&|<>]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SENTENCE_END = r"[.!?:;\"'\)\]…]\s*$"
MIN_WORDS = 50
WINDOW = 3
GOOD, ABSTAIN, BAD = 1, 0, -1

# rule: (statistic, reads as good up to, reads as bad from); between the two it abstains
RULES = {
    "few_symbols": ("symbols_per_word", 0.05, 0.15),
    "few_repeated_words": ("repeated_share", 0.15, 0.30),
    "few_dup_lines": ("dup_line_share", 0.10, 0.30),
    "few_capitals": ("upper_share", 0.15, 0.40),
    "few_exclamations": ("exclaim_per_word", 0.05, 0.20),
    "few_echoed_words": ("echo_share", 0.10, 0.25),
    "usual_word_length": ("word_length_off", 2.0, 4.0),
    "few_odd_ends": ("odd_end_share", 0.30, 0.60),
}
ITERATIONS = 40
PRIOR_GOOD = 0.8
# a rule may vote bad on this share of good documents; without the bound, one frequent kind of junk
# that only one rule knows would be explained as a careless rule
MAX_FALSE_ALARMS = 0.01
# one bad vote outweighs good votes of the other rules at the start: each rule knows one kind of junk
FIRST_GIVEN_GOOD = {GOOD: 0.900, ABSTAIN: 0.095, BAD: 0.005}
FIRST_GIVEN_BAD = {GOOD: 0.750, ABSTAIN: 0.050, BAD: 0.200}


def with_repeated_words(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``n_repeat_words``: words inside ``window``-word runs that the text holds twice or more.

    Every word of such a run counts once, also those of its first occurrence. Runs are compared by
    64-bit fingerprints, within one text only. Only texts that repeat a run pay for keeping places.
    Intermediate arrays are columns of their own, as an expression in a lambda would be worked out
    for every element.
    """
    runs = F.size("_hashes") - (window - 1)
    keys = F.slice("_hashes", 1, runs)
    for shift in range(1, window):
        keys = F.zip_with(keys, F.slice("_hashes", shift + 1, runs), lambda key, word: F.xxhash64(key, word))
    placed = F.sort_array(F.transform("_keys", lambda key, i: F.struct(key.alias("key"), (i + 1).alias("place"))))
    pairs = F.zip_with(
        "_placed",
        F.slice("_placed", 2, F.size("_placed")),
        lambda a, b: F.when(a["key"] == b["key"], F.array(a["place"], b["place"])),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda pair: pair.isNotNull()))))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("until"), F.lit(0).alias("covered")),
        lambda state, s: F.struct(
            (s + window).alias("until"),
            (state["covered"] + s + window - F.greatest(s, state["until"])).alias("covered"),
        ),
        lambda state: state["covered"],
    )
    return (
        df.withColumn("_hashes", F.transform("words", lambda word: F.xxhash64(word)))
        .withColumn("_keys", F.when(runs > 1, keys))
        .withColumn("_placed", F.when(F.size(F.array_distinct("_keys")) < F.size("_keys"), placed))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("_keys", "_placed")
    )


def base_statistics(docs: DataFrame, kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``kept`` of ``docs`` with the counts all rules rest on, from ``text``.

    A null text has none of anything. A count takes the place of an input column of its name.
    """
    text = F.col("text")

    def characters(pattern: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")

    with_parts = with_repeated_words(
        docs.select(F.struct(*kept).alias("row"), whole(text).alias("text"))
        .withColumn("words", words(text))
        .withColumn("lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE)))
    )
    odd_ends = F.filter("lines", lambda x: ~x.rlike(SENTENCE_END))
    echoes = F.zip_with("_hashes", F.slice("_hashes", 2, F.size("_hashes")), lambda a, b: a == b)
    return with_parts.select(
        *[F.col("row")[name].alias(name) for name in kept],
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        characters(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(odd_ends).cast("long").alias("n_odd_ends"),
        characters("[A-Z]").alias("n_upper"),
        characters("[!?]").alias("n_exclaims"),
        F.size(F.filter(echoes, lambda same: same)).cast("long").alias("n_echoes"),
    )


def _share(part: str, of: str) -> Column:
    return F.col(part) / F.greatest(F.col(of), F.lit(1))


def rule_statistics() -> dict[str, Column]:
    """What each rule compares, from the columns of ``base_statistics``."""
    return {
        "symbols_per_word": _share("n_symbols", "n_words"),
        "repeated_share": _share("n_repeat_words", "n_words"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "upper_share": _share("n_upper", "word_chars"),
        "exclaim_per_word": _share("n_exclaims", "n_words"),
        "echo_share": _share("n_echoes", "n_words"),
        "word_length_off": F.abs(_share("word_chars", "n_words") - 5.5),
        "odd_end_share": _share("n_odd_ends", "n_lines"),
    }


def vote(rule: str) -> Column:
    statistic, good, bad = RULES[rule]
    value = rule_statistics()[statistic]
    return F.when(value <= good, GOOD).when(value >= bad, BAD).otherwise(ABSTAIN)


Rates = list[tuple[dict[int, float], dict[int, float]]]


def fit_accuracies(patterns: list[tuple[tuple[int, ...], int]], rules: int) -> tuple[float, Rates]:
    """(share of good documents, per rule the vote probabilities given good and given bad) by EM.

    Rules are taken as independent given the quality. The fit starts from rules that seldom vote
    bad on a good document (and never more often than ``MAX_FALSE_ALARMS``), rates are smoothed by
    one vote of each kind, and a bad vote never counts for quality nor a good one against it, so
    the classes cannot change places.
    """
    prior, rates = PRIOR_GOOD, [(FIRST_GIVEN_GOOD, FIRST_GIVEN_BAD)] * rules
    total = sum(n for _, n in patterns)
    for _ in range(ITERATIONS if patterns else 0):
        weighed = [(votes, n, n / (1 + math.exp(-log_odds(votes, prior, rates)))) for votes, n in patterns]
        prior = min(max((sum(good for _, _, good in weighed) + 1) / (total + 2), 0.5), 0.99)
        rates = [_rates(weighed, rule) for rule in range(rules)]
    return prior, rates


def _rates(weighed, rule: int) -> tuple[dict[int, float], dict[int, float]]:
    good, bad = {GOOD: 1.0, ABSTAIN: 1.0, BAD: 1.0}, {GOOD: 1.0, ABSTAIN: 1.0, BAD: 1.0}
    for votes, n, g in weighed:
        good[votes[rule]] += g
        bad[votes[rule]] += n - g
    given_good = {v: n / sum(good.values()) for v, n in good.items()}
    given_bad = {v: n / sum(bad.values()) for v, n in bad.items()}
    excess = max(0.0, given_good[BAD] - MAX_FALSE_ALARMS)
    return {**given_good, GOOD: given_good[GOOD] + excess, BAD: given_good[BAD] - excess}, given_bad


def vote_weight(rate: tuple[dict[int, float], dict[int, float]], cast: int) -> float:
    """What a vote adds to the log odds of good quality; abstaining adds nothing."""
    given_good, given_bad = rate
    weight = math.log(given_good[cast] / given_bad[cast])
    return max(weight, 0.0) if cast == GOOD else min(weight, 0.0) if cast == BAD else 0.0


def log_odds(votes, prior: float, rates: Rates) -> float:
    """Kept within +-30, beyond which a probability is 0 or 1 for any use."""
    added = sum(vote_weight(rate, cast) for cast, rate in zip(votes, rates, strict=True))
    return max(-30.0, min(30.0, math.log(prior / (1 - prior)) + added))


def judge_quality(docs: DataFrame, threshold: float = 0.5, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with (statistics, posterior, base_failed, kept) of ``text``, a row per row.

    ``base_failed`` holds for under 50 words and for texts of which more than half stands in
    repeated 3-word runs. The statistics of all rows are written once; the vote patterns of all rows
    that did not fail are counted, EM fits the rules' accuracies to the counts, and each row gets
    the posterior probability that its quality is good. A row is kept when it did not fail and its
    posterior reaches ``threshold``.

    Null and empty texts have no words and fail. Repeated rows are judged alike, each counts in the
    fit. An empty table gives no rows. Further columns are ignored.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = stage(base_statistics(docs, columns).withColumn("base_failed", failed), "quality")
    votes = [vote(rule).alias(rule) for rule in RULES]
    counted = stats.where(~F.col("base_failed")).select(*votes).groupBy(*RULES).count().collect()
    prior, rates = fit_accuracies([(tuple(row[:-1]), row[-1]) for row in sorted(counted)], len(RULES))
    added = [
        F.when(vote(rule) == GOOD, vote_weight(rate, GOOD)).when(vote(rule) == BAD, vote_weight(rate, BAD)).otherwise(0.0)
        for rule, rate in zip(RULES, rates, strict=True)
    ]
    odds = reduce(lambda a, b: a + b, added, F.lit(math.log(prior / (1 - prior))))
    return stats.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    )


def keep_good(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with ``columns``; each row is judged on its own text."""
    return judge_quality(docs, columns=tuple(columns)).where("kept").select(*columns)
