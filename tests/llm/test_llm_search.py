"""Ranked search against brute force and its SQL twin."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from check_twins import oracle, table
from conftest import SF_DIR
from tabularium.llm import query_dag
from tabularium.llm.queries import ORACLE_SQL, QUERIES


def words(text):
    out, run = [], ""
    for ch in (text or "") + " ":
        if ch.isascii() and not ch.isalnum():
            out += [run] if run else []
            run = ""
        else:
            run += ch.lower() if "A" <= ch <= "Z" else ch
    return out


def brute(docs, items, k):
    held = [(i, Counter(words(t))) for i, t in docs if words(t)]
    count, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(words(t))
    out = set()
    for item, ts in asked.items():
        scores = []
        for doc, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * count // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in ts if c[t])
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out |= {(item, n + 1, doc, -s) for n, (s, doc) in enumerate(sorted(scores)[:k])}
    return out


def rows_of(frame):
    return {(r.item, r["rank"], r.doc, r.score) for r in frame.collect()}


@pytest.mark.parametrize("folder", [SF_DIR])
def test_whole_table(spark, folder):
    got = QUERIES["op11_query_dag"](spark, folder)
    cur = oracle(folder).execute(ORACLE_SQL["op11_query_dag"])
    assert table([d[0] for d in cur.description], cur.fetchall()) == table(got.columns, [tuple(r) for r in got.collect()])


def frames(spark, docs, items):
    return (spark.createDataFrame([(1, a, b, "x") for a, b in docs], "rank int, doc_id long, text string, term string"),
            spark.createDataFrame([(a, b, 2) for a, b in items], "item_id long, text string, doc int"))


def test_edges(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ñu", "日本", "A1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, text(rng.randint(0, 40))) for i in range(200)]
    docs += [(500, None), (501, ""), (502, "--- ... \n"), (None, "w1 w2 w3"), (503, "W1,w1;É.é " * 5000), (504, "w1 " * 200_000)]
    docs += docs[:3] + [(600 + i, "w5 w6") for i in range(80)]  # repeated rows, ties
    items = [(i, text(12)) for i in range(25)]
    items += [(40, None), (41, ""), (42, "absent"), (None, "w1"), (43, "w5"), (43, "w6 W6"), items[0], (44, "w1 É 日本 -- ñu")]
    d, q = frames(spark, docs, items)
    want = brute(docs, items, 7)
    assert rows_of(query_dag.search(d, q, 7)) == {(i, n, doc, s) for i, n, doc, s in want}
    assert rows_of(query_dag.search(d.repartition(9), q, 7, block_terms=40)) == want  # items in several blocks
    assert rows_of(query_dag.search(d, q, 10_000)) == brute(docs, items, 10_000)
    assert query_dag.search(d.limit(0), q).collect() == query_dag.search(d, q.limit(0)).collect() == []
    assert query_dag.search(d.filter("doc_id IN (500, 501)"), q).collect() == []


def test_shared_sets_give_the_same_sums():
    rng = np.random.default_rng(2)
    for n_items in (1, 2, 12, 60):
        common = [rng.choice(40, 6, replace=False).tolist() for _ in range(4)]
        items = [sorted({*common[rng.integers(4)], *common[rng.integers(4)], *rng.choice(120, 5).tolist()}) for _ in range(n_items)]
        dag = query_dag.mined(120, items)
        value = rng.integers(1, 1000, (120, 9))
        term, doc = np.nonzero(rng.random((120, 9)) < 0.5)
        dense = np.zeros((120, 9), np.int64)
        dense[term, doc] = value[term, doc]
        got = query_dag.accumulated(dag, term, doc, value[term, doc], 9)
        assert (got == np.stack([dense[i].sum(0) for i in items])).all()
        for n, children in enumerate(dag.sets):
            assert (children < 120 + n).all()
        used = Counter(c for parts in dag.sets + dag.items for c in parts.tolist())
        shared = [120 + n for n in range(len(dag.sets))]
        assert all(used[s] for s in shared)
        if n_items >= 12:  # fewer additions than one by one
            assert sum(map(len, dag.sets + dag.items)) < 0.8 * sum(map(len, items))


def test_copies_of_a_long_item_are_one_set():
    dag = query_dag.mined(30_000, [list(range(30_000))] * 3 + [[0, 1, 2]])
    assert max(map(len, dag.items)) <= 3
