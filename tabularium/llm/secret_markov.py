"""Secret scan in DataFrame functions only: fixed shapes, then two character Markov models.

Fixed shapes (assignments, access keys, long hex runs) give the base spans. A further span of kind `random` is a long
identifier-like run, not within one base span, whose characters follow each other as in random strings rather than as in
ordinary identifiers: the log-likelihood ratio of two first-order models must reach `LEAST_RATIO`, which stands for the
odds that a run is ordinary. Both models are trained from labelled strings of the table itself: all base spans are the
random ones; runs in text with the base spans taken out are the ordinary ones, from the `SAMPLE` documents with the
smallest key hash, whatever the size of the table. Scanning covers every character of every text.

Positions are code points, ends exclusive. Spark finds all matches and all gaps of a pattern in two passes; a running sum
of their lengths places them. Patterns are tried only on texts that can hold them. Rows are not shuffled.

Edge cases: a null text is empty and has no spans. Base spans may overlap; all stay. A
random run that reaches beyond a base span is a span of its own, so that the rest of the secret is marked too. Without a base span anywhere, or
without ordinary runs, no model can be trained and no span is added. Repeated rows are scanned alike; an empty table
gives an empty result. Other columns are ignored by `scan` and kept by `redact`, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
# The base shapes, and the least lengths of what they must match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

RUN_CHARS = "A-Za-z0-9+/_=-"
LEAST_RUN = 20
RUN = f"(?<![{RUN_CHARS}])[{RUN_CHARS}]{{{LEAST_RUN},}}+"
SAMPLE = 2000  # documents that the model of ordinary runs is trained on
LEAST_RATIO = 14.0  # natural log of the odds, about a million to one
SYMBOLS = 128
DRAWN = 100.0  # pseudo-counts behind the plain character frequencies


def length(x: Column) -> Column:
    return F.char_length(x)


def matches(text: Column, pattern: str, possible: Column, wanted) -> Column:
    """Array of structs (start, end) of the non-overlapping matches for which `wanted(match)` holds."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + length(x["gap"])
        end = start + length(x["hit"])
        return F.struct(end.alias("at"), F.when(wanted(x["hit"]), F.concat(acc["out"], F.array(
            F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["out"]).alias("out"))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern)
    # the gap behind the last match has no partner and is left out by its null
    both = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda x: x["hit"].isNotNull())
    found = F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("out")), place, lambda acc: acc["out"])
    return F.when(possible, found).otherwise(none)


def base_spans(text: Column) -> list[Column]:
    """Span arrays of the kinds assign, access and hex."""
    low = F.lower(text)
    any_word = F.lit(False)
    for w in ASSIGN_WORDS:
        any_word = any_word | low.contains(w)
    return [
        matches(text, ASSIGN, any_word & text.rlike(ASSIGN),
                lambda m: length(F.regexp_extract(m, ASSIGN, 1)) >= ASSIGN_VALUE),
        matches(text, ACCESS, text.contains("AKIA"), lambda m: F.lit(True)),
        matches(text, HEX, text.rlike(HEX), lambda m: F.lit(True)),
    ]


def with_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def pairs_of(run: Column) -> Column:
    """Codes of the neighbouring characters of an ASCII run."""
    return F.transform(F.sequence(F.lit(1), length(run) - 1), lambda i: (
        F.ascii(F.substring(run, i, F.lit(1))) * SYMBOLS + F.ascii(F.substring(run, i + 1, F.lit(1)))))


def pair_counts(runs: DataFrame) -> dict[int, int]:
    """Counts of neighbouring characters over rows (run); at most SYMBOLS ** 2 entries."""
    pairs = runs.filter(length(F.col("run")) > 1).select(F.explode(pairs_of(F.col("run"))).alias("pair"))
    return {r["pair"]: r["count"] for r in pairs.groupBy("pair").count().collect() if r["pair"] is not None}


def log_ratios(random: dict[int, int], ordinary: dict[int, int]) -> list[float] | None:
    """log P(next | random) - log P(next | ordinary) by pair code; None if either sample is empty."""
    if not random or not ordinary:
        return None
    used = sorted({c for p in (*random, *ordinary) for c in (p // SYMBOLS, p % SYMBOLS)})
    one, other = log_model(random, used), log_model(ordinary, used)
    return [one.get(p, 0.0) - other.get(p, 0.0) for p in range(SYMBOLS ** 2)]


def log_model(pairs: dict[int, int], used: list[int]) -> dict[int, float]:
    """log P(next | character) by pair code, drawn towards the plain frequencies of characters seldom seen before."""
    total = sum(pairs.values()) + len(used)
    plain = {b: 1.0 / total for b in used}
    seen = dict.fromkeys(used, 0)
    for p, n in pairs.items():
        plain[p % SYMBOLS] += n / total
        seen[p // SYMBOLS] += n
    return {a * SYMBOLS + b: math.log((pairs.get(a * SYMBOLS + b, 0) + DRAWN * plain[b]) / (seen[a] + DRAWN))
            for a in used for b in used}


def train(texts: DataFrame, id_col: str) -> list[float] | None:
    """The table of log ratios from rows (id, _text): every base span, and a bounded sample of ordinary runs."""
    text = F.col("_text")
    values = F.concat(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
                      F.regexp_extract_all(text, F.lit(HEX), F.lit(0)))
    held = texts.filter(text.rlike(ACCESS) | text.rlike(HEX) | text.rlike(ASSIGN))
    random = held.select(F.explode(values).alias("run")).filter(length(F.col("run")) >= ASSIGN_VALUE)
    bare = text
    for shape in (ASSIGN, ACCESS, HEX):
        bare = F.regexp_replace(bare, shape, " ")
    # the bound of the sample is found from the keys alone, so that only its texts travel
    place = F.xxhash64(id_col)
    most = texts.select(place.alias("place")).orderBy("place").limit(SAMPLE).agg(F.max("place")).first()[0]
    sample = texts.filter(place <= F.lit(most)).orderBy(place, F.xxhash64(text)).limit(SAMPLE)
    ordinary = sample.select(F.explode(F.regexp_extract_all(
        bare, F.lit(f"[{RUN_CHARS}]{{{ASSIGN_VALUE},}}"), F.lit(0))).alias("run"))
    return log_ratios(pair_counts(random), pair_counts(ordinary))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: Column | None = None) -> DataFrame:
    """`head` (the id) and n_assign, n_access, n_hex, base, spans: arrays of (start, kind number, end) in order."""
    texts = docs.select(head if head is not None else F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    ratios = train(docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text")), id_col)
    kept, text = texts.columns[0], F.col("_text")
    assign, access, hexes = base_spans(text)
    rows = texts.select(kept, "_text", assign.alias("_assign"), access.alias("_access"), hexes.alias("_hex"))
    base = F.sort_array(F.concat(*[with_kind(F.col(f"_{k}"), i) for i, k in enumerate(KINDS[:3])]))
    rows = rows.select(kept, "_text", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]], base.alias("base"))
    if ratios is None:
        more = F.array().cast("array<struct<start:int,end:int>>")
    else:
        table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")  # a constant

        def random(run: Column) -> Column:
            total = F.aggregate(pairs_of(run), F.lit(0.0), lambda acc, p: acc + F.get(table, p))
            return total >= LEAST_RATIO

        more = matches(text, RUN, text.rlike(RUN), random)
    rows = rows.select(kept, "n_assign", "n_access", "n_hex", "base", more.alias("_more"))
    free = F.filter("_more", lambda m: ~F.exists("base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])))
    return rows.select(kept, "n_assign", "n_access", "n_hex", "base",
                       F.sort_array(F.concat(F.col("base"), with_kind(free, 3))).alias("spans"))


def written_out(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The input with every span of its text replaced; overlapping spans are replaced as one. A null text stays null."""
    found = scan(docs, id_col, text_col, head=F.struct(F.col("*")).alias("_row"))
    text = F.col("_row").getField(text_col)

    def cut(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(new, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, length(text))))
    fields = [F.col("_row").getField(c).alias(c) if c != text_col else
              F.when(F.size("spans") > 0, clean).otherwise(text).alias(c) for c in docs.columns]
    return found.select(*fields)
