"""Ranked lexical search of many items at once, by common-subexpression evaluation.

An item's score for a document is a sum over the item's terms, so items that share terms share partial sums. `mined`
finds the shared term sets of a block of items: terms held by the same items become one set, then the pair of sets held
together by most items is joined until no pair is shared. The sets form a DAG, sets below items. For every block of
documents the partial sum of each set is worked out once (`accumulated`) and an item adds its sets and the terms that
only it holds. The DAG decides the number of additions, never a score.

The corpus is read once per block of items: a document keeps its length and the counts of the terms that the items ask
for, written to the scratch area. Term statistics are folded from that table over all documents. Every task keeps the
best `k` documents of each item among its own; a window picks the best of those. Items are taken in blocks of about
`BLOCK_TERMS` terms, so what is sent to the tasks has a bound; documents are never sent anywhere.

Edge cases: null and empty texts have no term; such documents count in no statistic, such items have no row, as have
items whose terms no document holds. Rows of items that share an id are one item with the terms of all; a null item id
takes no part. Every row of `docs` is a document, repeated rows too: they tie and both are listed. A document with a null
id counts in the statistics and is not listed. Empty tables give no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.llm.words import runs
from tabularium.session import written

BLOCK_TERMS = 1 << 16
PAIRED = 64
BLOCK_CELLS = 1 << 22
# Terms are runs of ASCII letters, digits and characters beyond ASCII; A-Z count as a-z
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


@dataclass
class Dag:
    """Sets are numbered after the terms, children before parents; items list terms and sets that share no term."""

    n_terms: int
    sets: list[np.ndarray]
    items: list[np.ndarray]


def mined(n_terms: int, items: list[list[int]]) -> Dag:
    """Sets of terms that two or more items share, each built from smaller ones."""
    holders = defaultdict(set)
    for i, held in enumerate(items):
        for t in held:
            holders[t].add(i)
    sets: list[np.ndarray] = []
    parts: list[set[int]] = [set() for _ in items]
    where: dict[int, set[int]] = {}
    alike = defaultdict(list)
    for t in sorted(holders):
        alike[frozenset(holders[t])].append(t)
    for held_by, members in alike.items():  # terms of the same items
        if len(members) > 1 and len(held_by) > 1:
            members = [n_terms + len(sets)]
            sets.append(np.array(alike[held_by]))
        for i in held_by:
            parts[i].update(members)
        if len(held_by) > 1:
            where[members[0]] = set(held_by)

    # pairs among the symbols of an item that most items hold; the rest is added one by one
    paired = [set(heapq.nsmallest(PAIRED, (s for s in p if s in where), key=lambda s: (-len(where[s]), s))) for p in parts]
    for s in where:
        where[s] = {i for i in where[s] if s in paired[i]}
    count = Counter(pair for p in paired for pair in combinations(sorted(p), 2))
    heap = [(-n, pair) for pair, n in count.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (a, b) = heapq.heappop(heap)
        now = count[a, b]
        if now < 2:
            continue
        if now != -n:
            heapq.heappush(heap, (-now, (a, b)))
            continue
        new, both = n_terms + len(sets), where[a] & where[b]
        sets.append(np.array([a, b]))
        where[a] -= both
        where[b] -= both
        where[new] = both
        grown = set()
        for i in both:
            parts[i] -= {a, b}
            paired[i] -= {a, b}
            for s in paired[i]:
                count[min(a, s), max(a, s)] -= 1
                count[min(b, s), max(b, s)] -= 1
                count[s, new] += 1
                grown.add(s)
            parts[i].add(new)
            paired[i].add(new)
        count[a, b] = 0
        for s in grown:
            if count[s, new] > 1:
                heapq.heappush(heap, (-count[s, new], (s, new)))
    return Dag(n_terms, sets, [np.array(sorted(p)) for p in parts])


def accumulated(dag: Dag, term: np.ndarray, doc: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores (items x documents) from the values of (term, document) entries."""
    partial = np.zeros((dag.n_terms + len(dag.sets), n_docs), np.int64)
    partial[term, doc] = value
    for i, children in enumerate(dag.sets):
        np.add.reduce(partial[children], axis=0, out=partial[dag.n_terms + i])
    return np.stack([partial[parts].sum(axis=0) for parts in dag.items])


def best(item: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of each item, by score, then by document."""
    order = np.lexsort((doc, -score, item))
    of = item[order]
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.empty(0, int)
    rank = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    return order[rank < k]


def item_terms(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(item, term), each once."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in runs([batch], 1, 1 << 20):
                found = [sorted(set(terms(t))) for t in texts]
                ids = np.repeat(np.asarray(part.column(0)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([t.decode() for f in found for t in f], pa.string())], ["item", "term"])

    return (items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long"), F.col(item_text).cast("string"))
            .mapInArrow(split, "item long, term string").distinct())


def counted(docs: DataFrame, doc_id: str, text: str, vocabulary: list[str]) -> DataFrame:
    """doc, n (terms of the document), and numbers and counts of the asked terms it holds; only documents with a term."""
    number = docs.sparkSession.sparkContext.broadcast({t.encode(): i for i, t in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = number.value
        for part, texts in runs(batches, 1, 1 << 22):
            n, held, offsets = [], [], [0]
            for t in texts:
                found = terms(t)
                n.append(len(found))
                held += [(at[w], c) for w, c in Counter(found).items() if w in at]
                offsets.append(len(held))
            term, tf = (pa.array([h[i] for h in held], t) for i, t in ((0, pa.int32()), (1, pa.int64())))
            offsets = pa.array(offsets, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, term),
                 pa.ListArray.from_arrays(offsets, tf)], ["doc", "n", "term", "tf"])
            yield out.filter(pa.array(np.array(n) > 0))

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        count, "doc long, n long, term array<int>, tf array<long>")


def ranked(held: DataFrame, dag: Dag, ids: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc, score): the k best of each item among the documents of a task."""
    plan = held.sparkSession.sparkContext.broadcast((vars(dag), ids, weight))  # arrays; the class comes with the task
    step = max(16, min(512, BLOCK_CELLS // (dag.n_terms + len(dag.sets) + len(dag.items))))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, ids, weight = plan.value
        dag = Dag(**sets)
        least = np.ones(len(ids), np.int64)
        kept = [np.empty(0, np.int64)] * 3
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                doc, n = (np.asarray(part.column(c)) for c in (0, 1))
                length = np.diff(np.asarray(part.column(2).offsets))
                row = np.repeat(np.arange(len(doc)), length)
                term, tf = (np.asarray(part.column(c).flatten()) for c in (2, 3))
                m = 50 + 50 * n * n_docs // n_terms
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
                score = accumulated(dag, term, row, value, len(doc))
                item, at = np.nonzero(score >= least[:, None])
                kept = [np.concatenate(c) for c in zip(kept, (item, doc[at], score[item, at]))]
                if len(kept[0]) > 4 * k * len(ids):
                    kept = [c[best(*kept, k)] for c in kept]
                    full = np.flatnonzero(np.bincount(kept[0], minlength=len(ids)) == k)
                    low = np.full(len(ids), np.iinfo(np.int64).max)
                    np.minimum.at(low, kept[0], kept[2])
                    least[full] = np.maximum(least[full], low[full])
        item, doc, score = (c[best(*kept, k)] for c in kept)
        yield pa.RecordBatch.from_arrays([pa.array(ids[item]), pa.array(doc), pa.array(score)], ["item", "doc", "score"])

    return held.filter("doc IS NOT NULL").mapInArrow(evaluate, "item long, doc long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item, rank (from 1), doc, score (above 0): the k best documents of every item, ties to the smaller document id."""
    spark = docs.sparkSession
    asked = written(item_terms(items, item_id, item_text), "item-terms")
    blocks = max(1, math.ceil(asked.count() / block_terms))
    found = spark.createDataFrame([], "item long, doc long, score long")
    for b in range(blocks):
        pairs = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item", "term").toArrow()
        if not pairs.num_rows:
            continue
        ids, of = np.unique(np.asarray(pairs["item"]), return_inverse=True)
        vocabulary = sorted(set(pairs["term"].to_pylist()))
        number = {t: i for i, t in enumerate(vocabulary)}
        held_by: list[list[int]] = [[] for _ in ids]
        for i, t in zip(of.tolist(), pairs["term"].to_pylist()):
            held_by[i].append(number[t])
        held = written(counted(docs, doc_id, text, vocabulary), "term-counts")
        total = held.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        if not total.n:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in held.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # at most one row a term
            df[r.t] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * total.n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        found = found.union(ranked(held, mined(len(vocabulary), held_by), ids, weight, total.n, total.l, k))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
