"""Toxicity scores from the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index.

Terms are words (lower-cased runs of letters and digits) and their beginnings of 3 to 6 characters. A vector holds the
terms that tell the labels apart: the `FEATURES` of highest log-likelihood ratio, `LEAST_GAIN` or more, among those that
toxic examples hold `LEAST_ODDS` times as often as others (so a common word stays out, however many examples there are). Counts are weighted (1 + ln tf) * ln((1 + N) / (1 + df)) with document frequencies over all
documents, and vectors have length 1.

Examples with equal vectors are one entry with its counts. Entries are sorted by their heaviest terms and cut into blocks; the index
knows, per term and block, the largest weight. The sum of a document's weights times these bounds every cosine in a
block, so blocks are opened in falling order of the bound until it falls below the cosine of the `NEIGHBOURS`-th example.
All examples at that cosine count. They vote with weight 1 / (distance + `NEAREST`), beside one far vote of the overall rate.
Votes become probabilities by isotonic regression over the examples' own votes, each without itself. A document without a term of the
index gets the rate among such examples.

The examples are a bounded sample, `EXAMPLES` labelled documents that the caller allows, chosen by the hash of their ids;
what goes to the tasks is the index over them. All documents are counted and scored, whole. Documents are read twice, once to
fetch the examples and once to count terms; only term counts of examples and of documents are shuffled.

Edge cases: null and empty texts hold no term. Without usable labels the score is 0.5. A label above 0 is toxic; rows
of one id count as toxic if one of them is; null labels, null ids and labels without a document teach nothing. Of documents
that share an id the smallest text is the example, and each is scored. A document with a null id is scored and is not
held out. Evidence lists ids, labels and cosines of nearest entries. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.words import runs
from tabularium.session import written

EXAMPLES = 16_384
FEATURES = 1024
LEAST_GAIN = 16.0
LEAST_ODDS = 5
NEIGHBOURS = 15
NEAREST = 0.1
BLOCK = 64
BEGINNINGS = (3, 4, 5, 6)
CACHED = 1 << 17
EVIDENCE = 3
# Fixed value: bytes of words in lower-cased UTF-8
WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words(text: str) -> Counter:
    return Counter(text.lower().encode().translate(WORD).split())


def parts(word: bytes) -> list[str]:
    """The word and its beginnings, which end with a star."""
    w = word.decode()
    return [w] + [w[:n] + "*" for n in BEGINNINGS if len(w) > n]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, teaches: Column, doc_id: str, text: str, label: str, most: int) -> DataFrame:
    """(id, toxic, text) of at most `most` labelled documents for which `teaches` (over the labels) holds."""
    known = labels.filter(teaches & F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max((F.col(label) > 0).cast("int")).alias("toxic"))
    # among ids that have a document, so that labels without one take no place
    there = known.join(docs.select(F.col(doc_id).cast("long").alias("id")).distinct(), "id", "left_semi")
    chosen = written(there.orderBy(F.xxhash64("id"), "id").limit(most), "examples")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "id")  # at most `most` rows
    return written(found.groupBy("id", "toxic").agg(F.min("text").alias("text")), "example-texts")


def counted_terms(known: DataFrame) -> DataFrame:
    """(term, pos, neg): how many toxic and other examples hold a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: tuple[Counter, Counter]) -> pa.RecordBatch:
            both = list(held[0].keys() | held[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(both, pa.string())] + [pa.array([h[t] for t in both], pa.int64()) for h in (held[1], held[0])],
                ["term", "pos", "neg"])

        held = Counter(), Counter()
        for part, texts in runs(batches, 1, 1 << 20):
            for toxic, t in zip(part.column(0).to_pylist(), texts):
                held[toxic].update({p for w in words(t) for p in parts(w)})
            if len(held[0]) + len(held[1]) > 1 << 20:
                yield out(held)
                held = Counter(), Counter()
        yield out(held)

    found = known.select("toxic", "text").mapInArrow(count, "term string, pos long, neg long")
    return found.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def chosen_terms(counts: DataFrame, pos: int, neg: int) -> list[str]:
    """Terms that toxic examples hold much more often, by falling log-likelihood ratio."""
    n = pos + neg
    with_it = F.col("pos") + F.col("neg")
    cells = [(F.col("pos"), with_it * pos / n), (F.col("neg"), with_it * neg / n),
             (pos - F.col("pos"), (n - with_it) * pos / n), (neg - F.col("neg"), (n - with_it) * neg / n)]
    gain = reduce(lambda a, b: a + b, (F.when(o > 0, 2 * o * F.ln(o / e)).otherwise(0.0) for o, e in cells))
    best = (counts.filter((F.col("pos") > 1) & (F.col("pos") * neg >= F.col("neg") * (LEAST_ODDS * pos))).withColumn("gain", gain)
            .filter(F.col("gain") >= LEAST_GAIN).orderBy(F.col("gain").desc(), "term").limit(FEATURES))
    return [r.term for r in best.collect()]


def term_counts(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The columns of `docs` but its last, the text, with the numbers and counts of the vocabulary's terms it holds."""
    number = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    kept = docs.schema[:-1] if len(docs.columns) > 1 else []
    shape = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + ["term array<int>", "tf array<int>"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cache = number.value, {}
        for part, texts in runs(batches, len(kept), 1 << 22):
            rows = []
            for t in texts:
                held: Counter = Counter()
                for w, c in words(t).items():
                    own = cache.get(w)
                    if own is None:
                        if len(cache) >= CACHED:
                            cache.clear()
                        own = cache[w] = [at[p] for p in parts(w) if p in at]
                    for p in own:
                        held[p] += c
                rows.append(sorted(held.items()))
            offsets = pa.array(np.cumsum([0] + [len(r) for r in rows]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array([x[i] for r in rows for x in r], pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *lists], [f.name for f in kept] + ["term", "tf"])

    return docs.mapInArrow(count, shape)


class Index:
    """Entries (distinct example vectors) in blocks, with the largest weight of each term in each block."""

    def __init__(self, idf: np.ndarray, rows: list[tuple[int, int, tuple[int, ...], tuple[int, ...]]], neighbours: int = NEIGHBOURS):
        """`rows`: id, toxic (0 or 1), terms and counts of each example."""
        self.idf, self.neighbours = idf, neighbours
        own: dict[tuple, list] = {}
        bare = [0, 0]
        for i, toxic, term, tf in sorted(rows):
            if term:
                own.setdefault((term, tf), []).append((i, toxic))
            else:
                bare[toxic] += 1
        vectors = {key: self.vector(np.array(key[0]), np.array(key[1])) for key in own}
        # entries with the same heavy terms stand together, so that a block has few terms
        order = sorted(own, key=lambda key: [t for _, t in sorted(zip(-vectors[key], key[0]))])
        self.keys = order
        self.n = np.array([len(own[k]) for k in order], float)
        self.pos = np.array([sum(y for _, y in own[k]) for k in order], float)
        self.shown = [own[k][0] for k in order]
        self.blocks, n_blocks = [], -(-len(order) // BLOCK)
        self.largest = np.zeros((len(idf), n_blocks))
        self.place = np.zeros((n_blocks, len(idf)), np.int32)
        for b in range(n_blocks):
            members = order[b * BLOCK:(b + 1) * BLOCK]
            held = sorted({t for k in members for t in k[0]})
            self.place[b, held] = np.arange(1, len(held) + 1)  # column 0 stands for terms that the block lacks
            weights = np.zeros((len(members), len(held) + 1))
            for i, k in enumerate(members):
                weights[i, self.place[b, list(k[0])]] = vectors[k]
            self.blocks.append(weights)
            self.largest[held, b] = weights[:, 1:].max(axis=0)
        total = sum(len(v) for v in own.values()) + sum(bare)
        positive = float(self.pos.sum()) + bare[1]
        self.rate = (positive + 1) / (total + 2)
        self.bare = (bare[1] + self.rate) / (sum(bare) + 1) if total else 0.5
        self.levels = self.calibrated()

    def vector(self, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        w = (1 + np.log(tf)) * self.idf[term]
        return w / np.sqrt((w * w).sum())

    def nearest(self, term: np.ndarray, weight: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the nearest examples and their ties; one example of entry `without` is left out."""
        bound = weight @ self.largest[term]
        entry, cosine, least = np.empty(0, int), np.empty(0), 1e-9
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] + 1e-8 < least:
                break
            got = np.round(self.blocks[b][:, self.place[b, term]] @ weight, 9)
            high = np.flatnonzero(got >= least)
            entry, cosine = np.concatenate([entry, high + b * BLOCK]), np.concatenate([cosine, got[high]])
            order = np.lexsort((entry, -cosine))
            entry, cosine = entry[order], cosine[order]
            held = np.cumsum(self.n[entry] - (entry == without))
            last = int(np.searchsorted(held, self.neighbours))
            if last < len(entry):
                least = cosine[last]
                end = int(np.searchsorted(-cosine, -least, side="right"))
                entry, cosine = entry[:end], cosine[:end]
        return entry, cosine

    def vote(self, entry: np.ndarray, cosine: np.ndarray, without: int = -1, label: int = 0) -> float:
        weight = 1 / (1 - np.minimum(cosine, 1) + NEAREST)
        own = (entry == without).astype(float)
        far = 1 / (1 + NEAREST)
        return float((weight @ (self.pos[entry] - own * label) + far * self.rate) / (weight @ (self.n[entry] - own) + far))

    def calibrated(self) -> tuple[np.ndarray, np.ndarray]:
        """Votes and the rates that belong to them, both rising: isotonic regression over the examples' votes."""
        seen = []
        for i, (term, tf) in enumerate(self.keys):
            term, weight = np.array(term), self.vector(np.array(term), np.array(tf))
            found = self.nearest(term, weight, without=i)
            seen += [(self.vote(*found, without=i, label=y), y, c) for y, c in ((1, self.pos[i]), (0, self.n[i] - self.pos[i])) if c]
        pools: list[list[float]] = []  # count, toxic, sum of votes
        for vote, y, c in sorted(seen):
            pools.append([c, y * c, vote * c])
            while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        at = np.array([v / c for c, _, v in pools])
        level = np.array([(p + self.rate) / (c + 1) for c, p, _ in pools])
        return at, np.maximum.accumulate(level) if len(level) else level

    def score(self, term: np.ndarray, tf: np.ndarray) -> tuple[float, list[tuple[int, int, float]]]:
        """The score and the nearest entries as (id, toxic, cosine)."""
        if not len(term) or not len(self.keys):
            return self.bare, []
        entry, cosine = self.nearest(term, self.vector(term, tf))
        shown = [(*self.shown[e], float(c)) for e, c in zip(entry[:EVIDENCE].tolist(), cosine.tolist())]
        return float(np.interp(self.vote(entry, cosine), *self.levels)), shown


def scored(docs: DataFrame, labels: DataFrame, teaches: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
           threshold: float = 0.7, most: int = EXAMPLES) -> DataFrame:
    """id, score, predicted, evidence (array of id, toxic, cosine) for every document."""
    spark = docs.sparkSession
    known = examples(docs, labels, teaches, doc_id, text, label, most)
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    vocabulary = chosen_terms(counted_terms(known), pos, neg) if pos and neg else []
    slim = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    held = written(term_counts(slim, vocabulary), "term-counts")
    total = held.count()
    df = np.zeros(len(vocabulary))
    for r in held.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # at most FEATURES rows
        df[r.t] = r["count"]
    taught = term_counts(known.select("id", "toxic", "text"), vocabulary).collect()  # at most `most` rows
    index = Index(np.log((1 + total) / (1 + df)) + 1e-6, [(r.id, r.toxic, tuple(r.term), tuple(r.tf)) for r in taught])
    sent = spark.sparkContext.broadcast(vars(index))  # arrays; executors may lack this package, and get the class with the task

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, cache = Index.__new__(Index), {}
        vars(index).update(sent.value)
        for batch in batches:
            out = []
            for term, tf in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                key = tuple(term), tuple(tf)
                if key not in cache:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[key] = index.score(np.array(term, int), np.array(tf, float))
                out.append(cache[key])
            score = [s for s, _ in out]
            evidence = pa.array([[dict(zip(("id", "toxic", "cosine"), e)) for e in shown] for _, shown in out],
                                pa.list_(pa.struct([("id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32()), evidence],
                ["id", "score", "predicted", "evidence"])

    return held.mapInArrow(judge, "id long, score double, predicted int, evidence array<struct<id:long,toxic:int,cosine:double>>")
