"""Operator 9, quality rules by weak supervision: rules vote or abstain, EM weighs them, the posterior decides.

Each text's counts come from array functions inside one projection (no
shuffle): words by ``split``, repeated 5-word windows by a hash per window,
sorted only where a text repeats one. Rules turn counts into votes (1 good, 0
bad, null abstains). The corpus is then a table of vote patterns with counts
(at most 3 ** rules rows, pre-aggregated); each EM round is one aggregate over
that table, returning the class share and each rule's chance to vote good in
either class. The posterior is a sum of log odds per document.

Only DataFrame functions run on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import documents
from arrears.session import materialize

BLANK = "[\\x20\\x09-\\x0D]+"
WINDOW = 5
ROUNDS = 30
#: chance of a good vote on good and on bad texts before any vote is seen, and the votes that this belief is worth
START, BELIEF = (0.99, 0.6), 10.0
#: the rule that tells which of the two classes is the good one
ANCHOR = "repeats"
PLAIN = r"[\p{L}\p{M}]+(?=[.,;:!?]?(?:[\x20\x09-\x0D]|\z))"


def _count(text: Column, pattern: str) -> Column:
    """Characters of the text outside ``pattern`` (a negated class)."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def text_counts(docs: DataFrame, window: int = WINDOW, extra=()) -> DataFrame:
    """doc_id, ``extra`` columns and the counts of every whole text (null text: empty).

    n_words, word_chars (code points in words), n_symbols, n_upper and
    n_digits, n_plain (runs of letters that end a word but for one mark),
    n_distinct (different words), n_lines (lines with a word), n_dup_lines (equal to an earlier
    one), n_ended (lines that end a sentence) and n_repeat_words (words in
    windows of ``window`` words found twice or more, the first included).
    """
    one = docs.select("doc_id", *extra, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one = one.withColumn("words", F.filter(F.split("text", BLANK, -1), lambda w: w != ""))
    one = one.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    places = F.expr(f"IF(size(words) >= {window}, sequence(0, size(words) - {window}), array())")
    gram = lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(window)])
    one = one.select(
        "doc_id", *extra, F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count(F.col("text"), "[^#*$%&|<>]").alias("n_symbols"), _count(F.col("text"), "[^A-Z]").alias("n_upper"), _count(F.col("text"), "[^0-9]").alias("n_digits"),
        F.regexp_count("text", F.lit(PLAIN)).cast("long").alias("n_plain"), F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike("[.!?][\\x20\\x09-\\x0D]*$"))).cast("long").alias("n_ended"),
        F.transform(places, gram).alias("grams"))
    # most texts repeat nothing; only the others sort their windows
    one = one.withColumn("sorted", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(
        F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    again = F.expr("""transform(sequence(0, size(sorted) - 1), k ->
        IF((k > 0 AND get(sorted, k - 1).g = sorted[k].g) OR get(sorted, k + 1).g <=> sorted[k].g, sorted[k].i, CAST(NULL AS INT)))""")
    one = one.withColumn("starts", F.sort_array(F.array_compact(again))).drop("grams", "sorted")
    covered = F.expr(f"""aggregate(starts, named_struct('n', 0L, 'last', -{window}), (a, x) ->
        named_struct('n', a.n + least({window}, x - a.last), 'last', x), a -> a.n)""")
    return one.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("starts")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(1))


def rule_votes() -> dict[str, Column]:
    """Vote of each rule: 1 good, 0 bad, null abstains. Texts without words get votes from length only.

    Every kind of bad text is seen by two rules that measure it differently:
    without that no rule's accuracy could be told from the votes. Some rules
    are weak on purpose (short texts, few ended lines, many digits).
    """
    words, lines, some = F.col("n_words"), F.col("n_lines"), F.col("n_words") > 0
    per_word = lambda c: F.col(c) / F.greatest(words, F.lit(1))
    per_char = lambda c: F.col(c) / F.greatest(F.col("word_chars"), F.lit(1))
    per_line = lambda c: F.col(c) / F.greatest(lines, F.lit(1))
    return {
        "length": _vote(words >= 30, words < 20),
        "symbols": _vote(some & (per_word("n_symbols") < 0.05), some & (per_word("n_symbols") > 0.2)),
        "plain": _vote(some & (per_word("n_plain") > 0.9), some & (per_word("n_plain") < 0.6)),
        "repeats": _vote(some & (per_word("n_repeat_words") < 0.05), some & (per_word("n_repeat_words") > 0.2)),
        "variety": _vote(some & (per_word("n_distinct") > 0.5), (words >= 50) & (per_word("n_distinct") < 0.25)),
        "dup_lines": _vote((lines >= 3) & (F.col("n_dup_lines") == 0), per_line("n_dup_lines") > 0.4),
        "capitals": _vote(some & (per_char("n_upper") < 0.15), some & (per_char("n_upper") > 0.4)),
        "digits": _vote(some & (per_char("n_digits") < 0.05), some & (per_char("n_digits") > 0.15)),
        "word_length": _vote(some & per_word("word_chars").between(3, 9), some & ~per_word("word_chars").between(1.5, 15)),
        "sentences": _vote((lines > 0) & (per_line("n_ended") >= 0.6), (lines >= 2) & (per_line("n_ended") < 0.3)),
    }


def _log_odds(names, share: float, chance: dict) -> Column:
    """Log odds of good; abstentions say nothing. The parameters enter as one array, so every round runs the same compiled code."""
    odds = [(math.log(g / b), math.log((1 - g) / (1 - b))) for g, b in (chance[r] for r in names)]
    told = F.array(F.lit(math.log(share / (1 - share))), *[F.lit(x) for pair in odds for x in pair])
    total = F.get(told, 0)
    for k, r in enumerate(names):
        total = total + F.when(F.col(r) == 1, F.get(told, 2 * k + 1)).when(F.col(r) == 0, F.get(told, 2 * k + 2)).otherwise(F.lit(0.0))
    return total


def fit_rules(votes: DataFrame, names, rounds: int = ROUNDS, share: float = 0.8, start=START, belief: float = BELIEF,
              anchor: str | None = None) -> tuple[float, dict]:
    """(share of good texts, {rule: (chance of a good vote on good texts, on bad texts)}) by expectation-maximisation.

    ``start`` is one pair for all rules or {rule: pair}; it counts as ``belief``
    votes of each class in every round, so that a rule that always abstains, or
    a corpus without votes, keeps it. No accuracy is bounded otherwise. In the
    end the good class is the one in which ``anchor`` votes good more often.
    """
    start = start if isinstance(start, dict) else {r: start for r in names}
    table = materialize(votes.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    chance = dict(start)
    for _ in range(rounds):
        seen = table.withColumn("p", 1 / (1 + F.exp(-_log_odds(names, share, chance))))
        sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("good")]
        for r in names:
            there, up = F.col(r).isNotNull(), F.col(r) == 1
            sums += [F.sum(F.when(up, F.col("n") * F.col("p"))).alias(f"{r}_gu"), F.sum(F.when(there, F.col("n") * F.col("p"))).alias(f"{r}_g"),
                     F.sum(F.when(up, F.col("n") * (1 - F.col("p")))).alias(f"{r}_bu"), F.sum(F.when(there, F.col("n") * (1 - F.col("p")))).alias(f"{r}_b")]
        row = {k: v or 0.0 for k, v in seen.agg(*sums).first().asDict().items()}
        share = min(max((row["good"] + belief * share) / (row["n"] + belief), 0.001), 0.999)
        chance = {r: tuple(min(max((row[f"{r}_{c}u"] + belief * start[r][k]) / (row[f"{r}_{c}"] + belief), 1e-6), 1 - 1e-6) for k, c in enumerate("gb")) for r in names}
    if anchor is not None and chance[anchor][0] < chance[anchor][1]:
        share, chance = 1 - share, {r: (b, g) for r, (g, b) in chance.items()}
    return share, chance


def quality_verdicts(docs: DataFrame, rounds: int = ROUNDS, threshold: float = 0.5) -> DataFrame:
    """Counts, votes and posterior quality of every text.

    ``docs`` needs doc_id and text; other columns are ignored. Returns one row
    per input row: doc_id, the counts of ``text_counts``, one vote column per
    rule, posterior, base_failed (fewer than 10 words, or over a fifth of them
    in repeated windows) and kept (not base_failed and posterior >= threshold).

    Null, empty and blank texts have counts 0 and are base_failed. Repeated rows
    are judged alike. A very long text is split and counted as one row; its
    windows are one array. Empty table: no rows.
    """
    rules = rule_votes()
    names = list(rules)
    votes = materialize(text_counts(docs).withColumns(rules), "votes")
    share, chance = fit_rules(votes, names, rounds, anchor=ANCHOR)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return votes.withColumn("posterior", 1 / (1 + F.exp(-_log_odds(names, share, chance)))).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
