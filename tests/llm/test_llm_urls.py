"""URL rules and character models."""

from pyspark.sql import functions as F

from conftest import SF_DIR
from tabularium.llm import url_ratio
from tabularium.llm.queries import RULES, QUERIES


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max((r.text for r in fits), key=len, default=None)


def test_whole_table(spark):
    got = {r.page_id: r for r in QUERIES["op1_url_ratio"](spark, SF_DIR).collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()
    verdicts = {r.text: r.verdict for r in RULES}
    assert len(got) == len(pages)
    for p in pages:
        row = got[p.page_id]
        assert (row.host, row.path, row.rule) == by_hand(p.url)
        assert row.verdict == verdicts.get(row.rule, row.verdict) and row.verdict in ("allow", "block")


def test_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.EXAMPLE.ORG?x", "http://example.org", "http://x.example.org/es/1",
            "http://notexample.org/es/", "http://b.com/de/#f/fr/", "a://b://c.com/fr/", "x://h.org/\nline", "http://é.org/" + "z" * 50_000]
    pages = spark.createDataFrame([(i % 11, u, "clash") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    got = url_ratio.judge(pages, RULES).collect()
    assert len(got) == 2 * len(urls)
    seen = sorted((r.page_id, r.host, r.path, r.rule or "") for r in got)
    assert seen == sorted((i % 11, h, p, t or "") for i, u in enumerate(urls) for h, p, t in [by_hand(u)] for _ in "ab")


def test_empty_and_untrained(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_ratio.judge(empty, RULES).collect() == []
    plain = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert {(r.verdict, r.score) for r in url_ratio.judge(plain, RULES).collect()} == {("allow", 0.0)}


def test_held_out_accuracy(spark):
    good = [(i, f"http://news{i % 37}.example.net/articles/{i}") for i in range(400)]
    bad = [(400 + i, f"http://casino-win{i % 41}.example.net/bets?id={i}") for i in range(400)]
    rules = [url_ratio.Rule(f"news{k}.example.net", "/", "allow") for k in range(18)] + [
        url_ratio.Rule(f"casino-win{k}.example.net", "/", "block") for k in range(20)]
    pages = spark.createDataFrame(good + bad, "page_id long, url string")
    free = url_ratio.judge(pages, rules).filter("rule IS NULL").withColumn("truth", F.when(F.col("page_id") < 400, "allow").otherwise("block"))
    right, total = free.filter("verdict = truth").count(), free.count()
    assert total > 300 and right / total > 0.97


def test_threshold_is_chosen_on_urls_the_models_have_not_seen(spark):
    """Both error rates of the held-out part are those that URLs of neither part have."""
    import random

    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(4, 8)))
    urls = [(k, f"x.example.net/{word('abcdefghij' if k else 'bcdefghijk')}") for _ in range(3000) for k in (True, False)]
    labelled = spark.createDataFrame(urls[:4000], "accepted boolean, text string")
    score, threshold = url_ratio.fit(labelled)
    fresh = spark.createDataFrame(urls[4000:], "accepted boolean, text string").select("accepted", score("text").alias("score")).collect()
    missed = [r.score < threshold.least for r in fresh if r.accepted]
    passed = [r.score >= threshold.least for r in fresh if not r.accepted]
    assert 0.05 < threshold.missed < 0.5 and 0.05 < threshold.passed < 0.5
    assert abs(sum(missed) / len(missed) - threshold.missed) < 0.08 and abs(sum(passed) / len(passed) - threshold.passed) < 0.08


def test_models_against_plain_python(spark):
    """Scores of the whole table from counts and interpolation worked out anew."""
    import math
    from collections import Counter

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()
    fold, verdicts = url_ratio.fold_table(), {r.text: r.verdict for r in RULES}
    text = {p.page_id: p.url.split("://", 1)[1] if "://" in p.url else p.url for p in pages}
    frame = spark.createDataFrame([(i, t) for i, t in text.items()], "i long, text string")
    apart = {r.i for r in frame.filter(F.pmod(F.xxhash64("text"), F.lit(url_ratio.HELD_OUT)) == 0).collect()}
    seen = {True: Counter(), False: Counter()}
    for p in pages:
        rule = by_hand(p.url)[2]
        if rule and p.page_id not in apart:
            s = b"\0\0\0" + text[p.page_id].encode().translate(fold) + b"\1"
            for i in range(3, len(s)):
                for order in range(4):
                    seen[verdicts[rule] == "allow"][s[i - order:i], s[i]] += 1
    after = {k: {} for k in seen}
    for k, counts in seen.items():
        for (context, _), n in counts.items():
            total, kinds = after[k].get(context, (0, 0))
            after[k][context] = total + n, kinds + 1

    def log_p(k, s, i):
        p = 1 / url_ratio.SYMBOLS
        for order in range(4):
            total, kinds = after[k].get(s[i - order:i], (0, 0))
            kinds = max(kinds, 1)
            p = (seen[k][s[i - order:i], s[i]] + kinds * p) / (total + kinds)
        return math.log(p)

    got = {r.page_id: r.score for r in QUERIES["op1_url_ratio"](spark, SF_DIR).collect()}
    for i, t in text.items():
        s = b"\0\0\0" + t.encode().translate(fold) + b"\1"
        want = sum(log_p(True, s, j) - log_p(False, s, j) for j in range(3, len(s))) / (len(s) - 3)
        assert abs(got[i] - want) < 1e-4
