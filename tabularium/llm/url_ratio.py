"""URL filter: rules first, then the likelihood ratio of two character models.

Two smoothed variable-order Markov models are trained on the URLs that a rule accepts and on those that a rule
rejects, but for one in `HELD_OUT` by the hash of its text, on which the threshold is chosen: models look better on the
URLs they have seen than on others. A character is predicted from up to three characters before it; each order is interpolated
with the next shorter one by the number of distinct characters seen after the context (Witten-Bell). A URL no rule fits
is judged by (log P(url | accepted) - log P(url | rejected)) / length against that threshold. Where the held-out part
lacks a kind, all labelled rows train and calibrate.

The model is one table over folded characters: `SYMBOLS ** 4` cells whatever the input, which bounds what is collected
and broadcast (10 MB). Counts come from the whole input and are folded before the shuffle.

Edge cases: a null url, or one without `://`, has an empty host and path and fits no rule; its whole text is scored, and
an empty text scores 0. Repeated rows are judged alike. With no labelled rows of one kind every score is 0 and the
verdict is allow. An empty table gives an empty result. Columns other than the id and the url are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, OTHER = 0, 1, 39
SYMBOLS = 40  # start, end, a-z, digit, ten marks, other
ORDER = 3
BIN = 100  # score bins per unit, for the calibration
HELD_OUT = 4  # one labelled text in so many calibrates
CLIP = 10  # scores are counted within -CLIP..CLIP


@dataclass(frozen=True)
class Rule:
    """Host and its subdomains, and paths that start with `path`; the text is `host + path`."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def fold_table() -> bytes:
    """Byte to symbol: letters in either case alike, all digits alike, marks of URLs, everything else."""
    table = bytearray([OTHER]) * 256
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = 2 + i
    for c in b"0123456789":
        table[c] = 28
    for i, c in enumerate(b"./-_?=&%#:"):
        table[c] = 29 + i
    return bytes(table)


def grams(texts: Sequence[str], fold: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The code of each predicted symbol with its three predecessors, and the number of the text it is from."""
    parts = [t.encode("utf-8", "surrogatepass").translate(fold) for t in texts]
    s = np.frombuffer(b"".join(b"\x00\x00\x00" + p + b"\x01" for p in parts), np.uint8).astype(np.int64)
    code = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:] if len(s) else s
    row = np.repeat(np.arange(len(parts)), [len(p) + 4 for p in parts])[3:] if len(s) else s
    own = s[3:] != START if len(s) else s.astype(bool)
    return code[own], row[own]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (text, verdict) of the longest rule that fits, else null."""
    found = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
               F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    return F.coalesce(*found)


def scored_text(url: Column) -> Column:
    """What the models see: the url after `://`, or all of it."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?:.*?://)?(.*)$", 1), F.lit(""))


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | three symbols before), interpolated down to a uniform start."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(ORDER + 1):
        n = counts.reshape(-1, SYMBOLS ** (order + 1)).sum(0).reshape(-1, SYMBOLS)
        kinds = np.maximum((n > 0).sum(1, keepdims=True), 1)
        shorter = np.tile(p.reshape(-1, SYMBOLS), (len(n) // max(1, p.size // SYMBOLS), 1))
        p = (n + kinds * shorter) / (n.sum(1, keepdims=True) + kinds)
    return np.log(p).ravel()


def train(labelled: DataFrame) -> np.ndarray:
    """The table of log ratios from rows (accepted boolean, text); all zero if either kind is missing."""
    fold = fold_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            accepted = np.array(batch.column(0).to_pylist(), bool)
            code, row = grams(batch.column(1).to_pylist(), fold)
            for kind in (True, False):
                codes, n = np.unique(code[accepted[row]] if kind else code[~accepted[row]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(codes), pa.bool_()), pa.array(codes), pa.array(n)], ["accepted", "code", "n"])

    folded = (labelled.select("accepted", "text").mapInArrow(count, "accepted boolean, code long, n long")
              .groupBy("accepted", "code").agg(F.sum("n").alias("n")))
    counts = np.zeros((2, SYMBOLS ** (ORDER + 1)))
    found = folded.toArrow()  # at most 2 * SYMBOLS ** 4 rows
    kind, code, n = (np.asarray(found[c].combine_chunks().to_numpy(zero_copy_only=False)) for c in ("accepted", "code", "n"))
    counts[kind.astype(int), code] = n
    if not counts.any(axis=1).all():
        return np.zeros(counts.shape[1], np.float32)
    return (log_probabilities(counts[1]) - log_probabilities(counts[0])).astype(np.float32)


def scorer(rows: DataFrame, ratios: np.ndarray):
    """A column function: mean log ratio per character of a text column."""
    shared, fold = rows.sparkSession.sparkContext.broadcast(ratios), fold_table()

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        code, row = grams(list(texts), fold)
        sums = np.bincount(row, shared.value[code], minlength=len(texts))
        return pd.Series(sums / np.maximum(np.bincount(row, minlength=len(texts)), 1))

    return score


@dataclass(frozen=True)
class Threshold:
    """Scores from `least` on are accepted; the shares of held-out rows of either kind that this gets wrong."""

    least: float
    missed: float = 0.0  # accepted rows below
    passed: float = 0.0  # rejected rows at or above


def calibrate(scored: DataFrame) -> Threshold | None:
    """The threshold with the least mean error over both kinds of labelled rows (accepted, score), nearest to 0.

    None if a kind is missing.
    """
    cell = F.floor(F.least(F.greatest("score", F.lit(-float(CLIP))), F.lit(float(CLIP))) * BIN).cast("int")
    hist = np.zeros((2, 2 * CLIP * BIN + 1))
    for kind, at, n in scored.groupBy("accepted", cell.alias("at")).count().collect():  # at most two rows a bin
        hist[int(kind), at + CLIP * BIN] = n
    if not hist.any(axis=1).all():
        return None
    share = hist / hist.sum(1, keepdims=True)
    missed = np.concatenate([[0.0], np.cumsum(share[1])])  # accepted rows below the edge
    passed = 1.0 - np.concatenate([[0.0], np.cumsum(share[0])])  # rejected rows at or above it
    edges = (np.arange(len(missed)) - CLIP * BIN) / BIN
    error = np.round(missed + passed, 12)
    best = min(np.flatnonzero(error == error.min()), key=lambda i: abs(edges[i]))
    return Threshold(float(edges[best]), float(missed[best]), float(max(0.0, passed[best])))


def fit(labelled: DataFrame):
    """A scorer of texts and its threshold, from rows (accepted, text)."""
    apart = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0
    score = scorer(labelled, train(labelled.filter(~apart)))
    found = calibrate(labelled.filter(apart).select("accepted", score("text").alias("score")))
    if found is None:
        score = scorer(labelled, train(labelled))
        found = calibrate(labelled.select("accepted", score("text").alias("score"))) or Threshold(0.0)
    return score, found


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, score: every row judged by its longest rule, else by the models."""
    rows = pages.select(F.col(id_col), F.col(url_col).alias("_url"))
    rows = rows.select(F.col(id_col), host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"),
                       scored_text(F.col("_url")).alias("_text"))
    rows = rows.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    labelled = rows.filter("_rule IS NOT NULL").select((F.col("_rule.verdict") == "allow").alias("accepted"),
                                                       F.col("_text").alias("text"))
    score, threshold = fit(labelled)
    scored = rows.withColumn("score", score("_text"))
    own = F.when(F.col("score") >= threshold.least, "allow").otherwise("block")
    return scored.select(F.col(id_col), "host", "path", F.col("_rule.text").alias("rule"),
                         F.coalesce("_rule.verdict", own).alias("verdict"), "score")
