"""Quality rules by weak supervision, in DataFrame functions only.

Each rule looks at whole-text counts and votes good (1), bad (-1) or abstains (0). Nobody says which rule is right:
expectation-maximisation estimates, from how the votes of all rows agree, how often each rule votes good on good and bad
on bad texts. A text's posterior probability of being good replaces "every rule must pass". A base check stays hard.

All counts are worked out inside the row. Rows are folded to vote patterns, of which there are at most 3 ** 6 whatever the
input; the patterns with their counts are collected and the estimation runs over them. Posteriors go back as a lookup by
pattern number. No row of the table is shuffled.

Edge cases: a null text is empty; a text without words fails the base check; repeated rows are judged alike; an empty
table gives an empty result. Texts of any length are read whole. Other columns are ignored by `measure` and kept by
`judge(keep_rows=True)`, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5
LEAST_WORDS = 10  # base check
MOST_REPEATED = 20  # base check: per cent of the words

VOTES = ("length_vote", "symbol_vote", "line_vote", "repeat_vote", "word_vote", "capital_vote")
ROUNDS = 50
PRIOR_GOOD = 0.8
PRIOR_WEIGHT = 20.0  # pseudo-votes behind the starting accuracies
START_GOOD = 0.998  # starting, and least, chance that a rule which votes on a good text votes good
START_BAD = 0.3  # and bad on a bad text: a text is mostly bad in one way, which the other rules do not see


def removed(text: Column, pattern: str) -> Column:
    """Number of code points that `pattern` matches."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def bound(value: Column, use) -> Column:
    """`use(value)`, with the value worked out once however often `use` refers to it, also inside its lambdas."""
    return F.transform(F.array(value), use)[0]


def repeat_positions(hashes: Column) -> Column:
    """Positions, rising, of the windows whose hash occurs more than once."""
    def repeats(order: Column) -> Column:
        marked = F.transform(order, lambda x, k: F.when(
            (x["h"] == F.get(order, k - 1)["h"]) | (x["h"] == F.get(order, k + 1)["h"]), x["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    return bound(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeats)


def measure(docs: DataFrame, head: Column, text_col: str = "text") -> DataFrame:
    """`head` and n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words of every document."""
    text, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    rows = docs.select(head, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kept = rows.columns[0]
    rows = rows.select(kept, "_text", F.filter(F.split(text, SPACE), lambda w: w != "").alias("_words"),
                       F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("_lines"))
    return rows.select(
        kept, F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        removed(text, r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        removed(text, "[A-Z]+").cast("long").alias("n_upper"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(F.transform(words, lambda w: F.xxhash64(w))).cast("long").alias("n_repeat_words"))


def repeated_words(word_hashes: Column) -> Column:
    """Words covered by windows of WINDOW words that occur more than once in the row."""
    def windows(h: Column) -> Column:
        n = F.size(h) - (WINDOW - 1)
        return F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
            *[F.get(h, i + k) for k in range(WINDOW)])))

    def covered(found: Column) -> Column:
        add = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last"))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(found, start, add, lambda acc: acc["n"])

    def count(w: Column) -> Column:
        return F.when(w.isNull() | (F.size(F.array_distinct(w)) == F.size(w)), F.lit(0)).otherwise(
            covered(repeat_positions(w)))

    return bound(word_hashes, lambda h: bound(windows(h), count))


def vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def votes() -> dict[str, Column]:
    n = F.col("n_words")
    return {
        "length_vote": vote(n < LEAST_WORDS, n >= 30),
        "symbol_vote": vote(F.col("n_symbols") * 10 > n, F.col("n_symbols") * 50 <= n),
        "line_vote": vote(F.col("n_dup_lines") * 10 > F.col("n_lines") * 3, (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2)),
        "repeat_vote": vote(F.col("n_repeat_words") * 5 > n, F.col("n_repeat_words") * 20 <= n),
        "word_vote": vote((F.col("word_chars") < n * 3) | (F.col("word_chars") > n * 9),
                          F.col("word_chars").between(n * 7 / 2, n * 15 / 2)),
        "capital_vote": vote(F.col("n_upper") * 10 > F.col("word_chars") * 3, F.col("n_upper") * 10 <= F.col("word_chars")),
    }


def pattern_number() -> Column:
    return sum(((F.col(v) + 1) * 3 ** i for i, v in enumerate(VOTES)), F.lit(0))


def pattern_votes(number: int) -> list[int]:
    return [number // 3 ** i % 3 - 1 for i in range(len(VOTES))]


def estimate(patterns: dict[int, int]) -> tuple[float, list[tuple[float, float]]]:
    """Share of good rows and, per rule, the chances to vote good on a good and bad on a bad row, by EM."""
    total = sum(patterns.values())
    share, rules = PRIOR_GOOD, [(START_GOOD, START_BAD)] * len(VOTES)
    for _ in range(ROUNDS if total else 0):
        good = {p: posterior(p, share, rules) for p in patterns}
        share = (sum(patterns[p] * good[p] for p in patterns) + PRIOR_WEIGHT * PRIOR_GOOD) / (total + PRIOR_WEIGHT)
        fitted = []
        for i in range(len(VOTES)):
            seen = [(patterns[p], good[p], v) for p in patterns if (v := pattern_votes(p)[i])]
            on_good = sum(n * g for n, g, _ in seen) + PRIOR_WEIGHT
            on_bad = sum(n * (1 - g) for n, g, _ in seen) + PRIOR_WEIGHT
            hit = sum(n * g for n, g, v in seen if v > 0) + PRIOR_WEIGHT * START_GOOD
            miss = sum(n * (1 - g) for n, g, v in seen if v < 0) + PRIOR_WEIGHT * START_BAD
            fitted.append((max(START_GOOD, hit / on_good), miss / on_bad))
        rules = fitted
    return share, rules


def posterior(pattern: int, share: float, rules: list[tuple[float, float]]) -> float:
    """Chance that a row with these votes is good."""
    odds = math.log(share) - math.log1p(-share)
    for v, (on_good, on_bad) in zip(pattern_votes(pattern), rules):
        if v > 0:
            odds += math.log(on_good) - math.log1p(-on_bad)
        elif v < 0:
            odds += math.log1p(-on_good) - math.log(on_bad)
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5,
          store=None, keep_rows: bool = False) -> DataFrame:
    """Counts, base_failed, posterior and kept per document; with `keep_rows`, the whole row as struct `_row` instead.

    `store` writes the counts once and reads them back (both passes then read the texts once); without it, or with
    `keep_rows`, the counts are worked out in each of the two passes.
    """
    measured = measure(docs, F.struct(F.col("*")).alias("_row") if keep_rows else F.col(id_col), text_col)
    if store is not None and not keep_rows:
        measured = store(measured)
    voted = measured.withColumns(votes()).withColumn("_pattern", pattern_number())
    found = {r["_pattern"]: r["count"] for r in voted.groupBy("_pattern").count().collect()}  # at most 3 ** 6 rows
    share, rules = estimate(found)
    # a constant list by pattern number
    table = ",".join(repr(posterior(p, share, rules)) for p in range(3 ** len(VOTES)))
    chance = F.get(F.split(F.lit(table), ",").cast("array<double>"), F.col("_pattern"))
    n = F.col("n_words")
    failed = (n < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > n * MOST_REPEATED)
    return voted.select(
        "_row" if keep_rows else id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), chance.alias("posterior"), (~failed & (chance >= least)).alias("kept"))
