"""Operators over documents against brute force, with their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from tabularium.llm import bbit_minhash, block_anchors, components, line_alignment, secret_markov, weak_rules
from tabularium.llm.queries import QUERIES
from tabularium.session import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TALE = " ".join(f"word{i}" for i in range(120))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, TALE), (7, TALE), (8, TALE.replace("word60 ", "")),
    (9, TALE + "\n" + TALE), (10, "a " * 40_000), (11, "x" * 50_000), (12, "é ü 😀 #$% |"),
    (13, 'token="abcdef" 😀 Api_Key: abc passwd=secret:abcdefgh'), (14, "AKIA" * 5 + " " + "0a" * 12 + "\n" + "0" * 23),
    (15, "same line of this text\nsecond line of the text\n\nx"), (16, "same line of this text\nother\nsecond line of the text\n\nx"),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(a, b, "clash", "clash", 1, "clash") for a, b in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, _row string, kept string, component_id int, spans string")


# -- near-duplicate groups ---------------------------------------------------------------------------------------------

def shingle_set(text, n):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = WORD.findall(text)
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_groups(texts, n):
    sets, parent, holders = {k: shingle_set(t, n) for k, t in texts.items()}, {k: k for k in texts}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in sets.items():
        for other, both in Counter(o for x in s for o in holders[x]).items():
            if 100 * both >= 80 * (len(s) + len(sets[other]) - both):
                a, b = root(k), root(other)
                parent[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(k)
    return {(k, len(sets[k]), root(k), root(k) == k) for k in texts}


def test_groups_whole_table(spark, texts):
    got = {tuple(r) for r in QUERIES["op4_bbit_minhash"](spark, SF_DIR).collect()}
    assert got == brute_groups(texts, 2)


@pytest.mark.parametrize("n", [2, 5])
def test_groups_edges(edges, n):
    got = bbit_minhash.groups(edges, n)
    want = brute_groups({k: t or "" for k, t in EDGES}, n)
    assert {tuple(r) for r in got.collect()} == want
    assert bbit_minhash.groups(edges.limit(0), n).collect() == []
    left = bbit_minhash.keep_one(edges.union(edges), n)
    assert left.columns == edges.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted([k for k, _, _, ok in want if ok] * 2)


def test_groups_of_chained_copies(spark):
    """Neighbours are similar, the ends are not: buckets hold members of several components for a while."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 4:i * 4 + 100])) for i in range(60)]
    rows += [(1000 + i, " ".join(words[:60] + [f"u{i}x{k}" for k in range(4)] + words[60:90])) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in bbit_minhash.groups(frame).collect()} == brute_groups(dict(rows), 2)


def test_groups_of_a_large_group_of_near_copies(spark, monkeypatch):
    """Edits of one text, many too far from it to be linked: every link is found, and few pairs are looked at."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(140)]
    rows = []
    for i in range(500):
        share = rng.choice([0.01, 0.03, 0.05, 0.08, 0.11])
        rows.append((i, " ".join(f"e{rng.randrange(400)}" if rng.random() < share else w for w in words)))
    seen = []
    links = bbit_minhash.Linker.links

    def counted(self, pairs):
        seen.append(pairs.distinct().count())
        return links(self, pairs)

    monkeypatch.setattr(bbit_minhash.Linker, "links", counted)
    got = {tuple(r) for r in bbit_minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(dict(rows), 2)
    assert len(seen) == 2 and seen[1] < 500 * 499 / 2 / 20


def test_estimate_is_close(spark):
    a, b = [f"w{i}" for i in range(1000)], [f"w{i}" for i in range(100, 1100)]
    frame = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string")
    s = bbit_minhash.sketches(frame, 1, "doc_id", "text")
    pair = s.filter("id = 1").select(F.col("signature").alias("x")).join(s.filter("id = 2").select(F.col("signature").alias("y")))
    assert abs(pair.select(bbit_minhash.estimate(F.col("x"), F.col("y"))).first()[0] - 900 / 1100) < 0.15


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 101), (7, 7), (None, 3)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 105: 100}


# -- repeated passages -------------------------------------------------------------------------------------------------

def brute_repeats(texts, width=35):
    words = [WORD.findall(t) for t in texts]
    times = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    for w in words:
        gone = {i + k for i in range(len(w) - width + 1) if times[tuple(w[i:i + width])] > 1 for k in range(width)}
        yield len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


def test_repeats_whole_table(spark, texts):
    got = {tuple(r) for r in QUERIES["op8_block_anchors"](spark, SF_DIR).collect()}
    want = {(k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, (n, m, t) in zip(texts, brute_repeats(texts.values()))}
    assert got == want


def test_repeats_edges(edges, monkeypatch):
    monkeypatch.setattr(block_anchors, "BUCKET_WORDS", 500)  # several buckets
    extra = [(None, "p " * 34), (17, "q " * 36), (18, " ".join(f"z{i % 36}" for i in range(75))), (7, TALE)]
    spark = edges.sparkSession
    rows = edges.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = block_anchors.remove(rows, F.pmod(F.xxhash64("doc_id", "text"), F.lit(5)))
    every = EDGES + extra
    key = lambda r: (r[0] or 0, *r[1:])
    want = [(k, *x) for (k, _), x in zip(every, brute_repeats([t or "" for _, t in every]))]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert block_anchors.remove(edges.limit(0), F.lit(1)).collect() == []


# -- secrets -----------------------------------------------------------------------------------------------------------

def brute_spans(t):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, t, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def text_of(spans):
    return ",".join(f"{secret_markov.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check_spans(row, text):
    base = brute_spans(text)
    assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
    added = [s for s in row.spans.split(",") if s.startswith("random")]
    assert [s for s in row.spans.split(",") if s and s not in added] == [s for s in text_of(base).split(",") if s]
    return base


def test_secrets_whole_table(spark, texts):
    for r in QUERIES["op7_secret_markov"](spark, SF_DIR).collect():
        base = check_spans(r, texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(text_of(base).encode()).hexdigest()


def test_secrets_edges(edges):
    out = secret_markov.scan(edges).select("doc_id", "n_assign", "n_access", "n_hex",
                                           secret_markov.written_out(F.col("spans")).alias("spans")).collect()
    assert len(out) == len(EDGES)
    for r in out:
        check_spans(r, dict(EDGES)[r.doc_id] or "")
    assert secret_markov.scan(edges.limit(0)).collect() == []
    clean = secret_markov.redact(edges)
    assert clean.columns == edges.columns
    for r in clean.collect():
        old = dict(EDGES)[r.doc_id]
        assert (r.text is None) == (old is None) and (r._row, r.kept, r.spans) == ("clash",) * 3
        assert not brute_spans(r.text or "") and (r.text == old or brute_spans(old))


def test_random_runs_are_told_from_identifiers(spark):
    """Held-out accuracy: the models see other secrets and other names."""

    rng = random.Random(4)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    names = ["internationalization_of_text", "characteristics-and-measures", "responsibilitiesWithoutLimits", "counterrevolutionaries",
             "misunderstandings_everywhere", "straightforwardInterpretation"]
    plain = ("the communication channel number and every representation of administrative responsibility without exception "
             "understanding general measures for straightforward interpretation characteristics of international revolution ")
    train = [(i, f'{plain * 3} token="{"".join(rng.choices(chars, k=32))}" {plain}') for i in range(200)]
    test = [(1000 + i, f"see {''.join(rng.choices(chars, k=28))} there") for i in range(20)]
    test += [(2000 + i, f"see {n} there") for i, n in enumerate(names)]
    key = "AKIA" + "".join(rng.choices(chars[26:52], k=16))
    train.append((3000, f"see {key}/{''.join(rng.choices(chars, k=28))} there, {key} alone"))
    found = {r.doc_id: r.n for r in secret_markov.scan(spark.createDataFrame(train + test, "doc_id long, text string")).select(
        "doc_id", F.size(F.filter("spans", lambda s: s["kind"] == 3)).alias("n")).collect()}
    assert sum(found[1000 + i] == 1 for i in range(20)) >= 19
    assert sum(found[2000 + i] for i in range(len(names))) <= 1
    assert found[3000] == 1  # the run that goes on behind the first key; the second key is covered by its base span
    left = {r.doc_id: r.text for r in secret_markov.redact(spark.createDataFrame(train, "doc_id long, text string")).collect()}
    assert left[3000] == "see [SECRET] there, [SECRET] alone"


# -- quality -----------------------------------------------------------------------------------------------------------

def brute_counts(t):
    words = WORD.findall(t)
    times = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if times[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


def check_quality(r, text):
    want = brute_counts(text)
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
    assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
    assert not (r.base_failed and r.kept)


def test_quality_whole_table(spark, texts):
    got = QUERIES["op9_weak_rules"](spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        check_quality(r, texts[r.doc_id])


def test_quality_accuracy(spark):
    """The labels are not used for fitting."""
    sf = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet").dropDuplicates(["doc_id"])
    both = QUERIES["op9_weak_rules"](spark, sf).join(labels, "doc_id").filter("NOT base_failed").collect()
    assert sum(r.kept for r in both if r.quality) >= 0.98 * sum(1 for r in both if r.quality)
    assert sum(not r.kept for r in both if not r.quality) >= 0.9 * sum(1 for r in both if not r.quality)


def test_quality_edges(edges):
    got = weak_rules.judge(edges, store=written).collect()
    assert len(got) == len(EDGES)
    for r in got:
        check_quality(r, dict(EDGES)[r.doc_id] or "")
    assert weak_rules.judge(edges.limit(0)).collect() == []
    rows = weak_rules.judge(edges, keep_rows=True).filter("kept").select("_row.*")
    assert rows.columns == edges.columns and {r.doc_id for r in rows.collect()} == {r.doc_id for r in got if r.kept}


def test_no_python_in_native_plans(edges):
    for frame in (weak_rules.judge(edges), secret_markov.scan(edges), secret_markov.redact(edges)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# -- line dedup --------------------------------------------------------------------------------------------------------

def bare(line):
    return line.strip(" \t\n\x0b\x0c\r")


def brute_lines(texts, least=20, rare=8):
    """Deleted line numbers per document, pair by pair."""
    lines, holders, gone = {k: t.split("\n") for k, t in texts.items()}, defaultdict(list), defaultdict(set)
    for k in sorted(lines):
        for x in lines[k]:
            if len(bare(x)) >= least:
                holders[bare(x)].append(k)
    pairs = set()
    for held in holders.values():
        for n, k in enumerate(held):
            pairs.add((held[0], k))
            if n and len(held) <= rare:
                pairs.add((held[n - 1], k))
    for a, b in pairs:
        if a < b:
            side = [[bare(x) for x in lines[k]] for k in (a, b)]
            gone[b].update(line_alignment.common_blocks(*side, [len(x) for x in side[1]], least))
    return gone


def check_lines(rows, texts):
    gone = brute_lines(texts)
    for r in rows:
        left = [x for i, x in enumerate(texts[r.doc_id].split("\n")) if i not in gone[r.doc_id]]
        assert (r.n_removed, r.text) == (len(gone[r.doc_id]), "\n".join(left))


def test_lines_whole_table(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = line_alignment.remove(docs).select("_row.doc_id", "text", "n_removed").collect()
    assert len(rows) == len(texts)
    check_lines(rows, texts)
    assert QUERIES["op6_line_alignment"](spark, SF_DIR).count() == len(texts)


def test_lines_edges(edges):
    rows = line_alignment.remove(edges).select("_row.doc_id", "text", "n_removed").collect()
    assert len(rows) == len(EDGES) and next(r for r in rows if r.doc_id == 1).text is None
    check_lines([r for r in rows if r.doc_id != 1], {k: t for k, t in EDGES if t is not None})
    assert next(r for r in rows if r.doc_id == 16).text == "other"
    assert line_alignment.remove(edges.limit(0)).collect() == []
    assert line_alignment.dedup(edges).columns == edges.columns


def test_patience():
    a, b = list("abcdefg"), list("xabdecfgz")
    pairs = line_alignment.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs) and [j for _, j in pairs] == sorted(j for _, j in pairs)
    assert len(pairs) >= 5
    assert line_alignment.patience([], [1]) == [] and line_alignment.patience([1, 1], [1, 1, 1]) == [(0, 0), (1, 1)]
