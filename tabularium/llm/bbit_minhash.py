"""Near-duplicate groups by b-bit MinHash.

A text's set is its distinct word shingles. Of 288 minima, groups of six make 48 band keys; texts that share a key are
candidates (two texts of similarity 0.8 share none with a chance of 5e-7). Of each minimum the lowest two bits are kept
and packed into nine longs; counting equal bit pairs of two signatures, less the quarter that agrees by chance, estimates
the similarity. Candidates whose estimate is too low by more than five standard deviations are dropped (chance 3e-8 to
drop a link); all others are confirmed on their full sets.

Texts with equal sets form a class and are represented by their smallest id. Within a bucket no pairs are listed: one
member is compared with all others, and bands differ in the order it is chosen by, so that a text meets several. If this
leaves members in different components, which have not been compared with each other, the member with most links becomes
the centre of its bucket, and each other member is described by the items in which it deviates from the centre. Two
members that are not linked with it can only be linked if they share deviations; how many follows from their sizes, and
an exact prefix filter over the rarest ones gives the candidates (`open_pairs`). So no link among candidates is lost, and
what all copies share makes no pairs.

Only texts that share a bucket are moved, once, and each pair is confirmed on its own. Hot buckets and hot
representatives are sides of plain joins, which adaptive execution splits. The one thing collected is a table of
`2 ** SLOT_BITS` counts, whatever the input.

Edge cases: a null text, an empty one and one without words have an empty set and are linked with nothing. A text with
fewer words than a shingle is one shingle. Ids are compared as numbers; rows with a null id and the same set as another
row are its copies, a null id alone has a null component and is kept. Repeated rows are all kept or all dropped with
their id. An empty table gives an empty result. Other columns are ignored by `groups`; `keep_one` keeps them, whatever
their names. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.components import components
from tabularium.llm.words import mixed, runs, shingles, word_hashes
from tabularium.session import written

MINIMA = 288
BANDS = 48
BITS = 2
SIMILARITY = 80  # per cent
ESTIMATE = 0.64  # least estimated similarity that is confirmed; five standard deviations below 0.8
SLOT_BITS = 20
ORDERS = 4  # orders by which a bucket's representative is chosen, dealt over the bands
BATCH_CHARS = 2_000_000
PAIR_BITS = 0x5555555555555555


def hash_family() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[:MINIMA] >> np.uint64(32)).astype(np.uint32), (seeds[MINIMA:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minima(items: np.ndarray, flip: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """The least of (item ^ flip) * factor per hash function, over 32-bit items."""
    low = np.full(len(flip), 0xFFFFFFFF, np.uint32)
    short = (items >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 1024):
        np.minimum(low, ((short[None, i:i + 1024] ^ flip[:, None]) * factor[:, None]).min(1), out=low)
    return low


def sketches(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, set_key (hash of the set), bands, signature (both null for an empty set)."""
    flip, factor = hash_family()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(BANDS, dtype=np.uint64)
        place = np.uint64(BITS) * np.arange(64 // BITS, dtype=np.uint64)
        for part, texts in runs(batches, 1, BATCH_CHARS):
            hashes, begin = word_hashes(texts, lower=True)
            sizes, keys, bands, packed = [], [], [], []
            for i in range(len(texts)):
                items = np.unique(shingles(hashes[begin[i]:begin[i + 1]], words))
                sizes.append(len(items))
                if not len(items):
                    keys.append(None), bands.append(None), packed.append(None)
                    continue
                low = minima(items, flip, factor).astype(np.uint64)
                key = number
                for row in low.reshape(BANDS, -1).T:
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
                kept = mixed(low) & np.uint64((1 << BITS) - 1)
                keys.append(xxhash.xxh3_128_digest(items.tobytes()))
                bands.append(key.view(np.int64))
                packed.append((kept.reshape(-1, len(place)) << place).sum(1, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64()))],
                ["id", "n_shingles", "set_key", "bands", "signature"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, "id long, n_shingles long, set_key binary, bands array<long>, signature array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two signatures: the share of equal minima, corrected for those whose kept bits agree by chance."""
    unlike = F.lit(0)
    for i in range(MINIMA * BITS // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        unlike = unlike + F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(PAIR_BITS)))
    chance = 2.0 ** -BITS
    return ((1 - unlike / MINIMA) - chance) / (1 - chance)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Linker:
    """Finds and confirms links between representatives whose texts are given as (id, _text)."""

    def __init__(self, texts: DataFrame, kept: DataFrame, words: int, percent: int):
        self.texts, self.signatures = texts, kept.select("id", "signature")
        self.words, self.percent = words, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links, written."""
        a, b = (self.signatures.select(F.col("id").alias(c), F.col("signature").alias(f"_{c}")) for c in "ab")
        likely = pairs.distinct().join(a, "a").join(b, "b").filter(estimate(F.col("_a"), F.col("_b")) >= ESTIMATE)
        likely = written(likely.select("a", "b").distinct(), "pairs")
        a, b = (self.texts.select(F.col("id").alias(c), F.col("_text").alias(f"_{c}")) for c in "ab")
        words, percent = self.words, self.percent

        def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    part, ok, known = batch.slice(at, 64), [], {}
                    for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                        for t in (x, y):
                            if t not in known:
                                known[t] = np.unique(shingles(word_hashes([t or ""], lower=True)[0], words))
                        ok.append(similar(known[x], known[y], percent))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(ok))

        with_texts = likely.join(a, "a").join(b, "b").select("a", "b", "_a", "_b")
        return written(with_texts.mapInArrow(confirm, "a long, b long"), "confirmed")

    def deviations(self, pairs: DataFrame) -> DataFrame:
        """a, b, their set sizes, and `keys`: hashes of (a, item, side) for the items that only one of the two sets holds."""
        a, b = (self.texts.select(F.col("id").alias(c), F.col("_text").alias(f"_{c}")) for c in "ab")
        words = self.words

        def items_of(text: str) -> np.ndarray:
            return np.unique(shingles(word_hashes([text or ""], lower=True)[0], words))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, centre = None, None  # rows come in the order of a
            for batch in batches:
                sizes, others, keys = [], [], []
                for node, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "_a", "_b"))):
                    if last != node:
                        last, centre = node, items_of(x)
                    own = items_of(y)
                    seed = mixed(np.array([2 * node, 2 * node + 1], np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    lacks = np.setdiff1d(centre, own, assume_unique=True)
                    adds = np.setdiff1d(own, centre, assume_unique=True)
                    keys.append(np.concatenate([mixed(lacks ^ seed[0]), mixed(adds ^ seed[1])]).view(np.int64))
                    sizes.append(len(centre)), others.append(len(own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(sizes, pa.int64()), pa.array(others, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64()))], ["a", "b", "n_a", "n_b", "keys"])

        with_texts = pairs.join(b, "b").join(a.hint("merge"), "a").select("a", "b", "_a", "_b")
        return written(with_texts.mapInArrow(run, "a long, b long, n_a long, n_b long, keys array<long>"), "deviations")

    def open_pairs(self, held: DataFrame) -> DataFrame:
        """Pairs of members (b) of one centre (a) with different components that can be links.

        Let c = (100 - percent) / (100 + percent). Sets x and y are linked if and only if they differ in at most
        c (|x| + |y|) items. With X and Y the deviations from their centre r, that difference is |X| + |Y| - 2 |X & Y|, so a
        link shares at least (|X| + |Y| - c (|x| + |y|)) / 2 deviations. Two members linked with r are in its component; of
        any other pair one, x, has |X| > c (|x| + |r|), which leaves more than (|Y| - c (|y| - |r|)) / 2 for y. Deviations
        are put in one order, rare ones first, and only as many of them are compared as that count allows to be missing,
        and one; the place of the first that is shared bounds the rest. What all copies share is no deviation, so it
        makes no pairs. Rarity is by counts per slot of the key's hash, any fixed order being exact.
        """
        percent, low, high = self.percent, 100 - self.percent, 100 + self.percent
        slot = F.shiftrightunsigned("key", 64 - SLOT_BITS).cast("int").alias("slot")
        counted = held.select(F.explode("keys").alias("key")).groupBy(slot).agg(F.count(F.lit(1)).alias("n"))
        table = np.zeros(1 << SLOT_BITS, np.int64)
        found = counted.toArrow()  # at most 2 ** SLOT_BITS rows
        table[np.asarray(found.column("slot").combine_chunks())] = np.asarray(found.column("n").combine_chunks())
        shared = held.sparkSession.sparkContext.broadcast(table)
        shift = np.uint64(64 - SLOT_BITS)

        def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, place, of, ends = [], [], [], ([], [])
                n_a, n_b = (np.asarray(batch.column(c)) for c in ("n_a", "n_b"))
                for i, own in enumerate(batch.column("keys")):
                    own = np.asarray(own.values)
                    size, n, centre = len(own), int(n_b[i]), int(n_a[i])
                    apart = high * size > low * (n + centre)
                    as_x = size - max(1, size - low * n // percent) + 1 if apart else 0
                    as_y = size - max(1, (high * size - low * (n - centre)) // (2 * high) + 1) + 1
                    most = max(as_x, as_y, 0)
                    order = np.lexsort((own, shared.value[(own.view(np.uint64) >> shift).astype(np.int64)]))[:most]
                    keys.append(own[order]), place.append(np.arange(most)), of.append(np.full(most, i))
                    ends[0].append(np.arange(most) < as_x), ends[1].append(np.arange(most) < as_y)
                of = pa.array(np.concatenate(of))
                sizes = pa.array([len(x) for x in batch.column("keys")], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(place)), pa.array(np.concatenate(ends[0])),
                     pa.array(np.concatenate(ends[1])), sizes.take(of), *(batch.column(c).take(of) for c in ("b", "n_b", "component"))],
                    ["key", "place", "as_x", "as_y", "size", "id", "n", "component"])

        rows = held.mapInArrow(rarest, "key long, place long, as_x boolean, as_y boolean, size long, id long, n long, component long")
        met = rows.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"),
                                      F.max("as_x").alias("_x")).filter("_low < _high AND _x").select("key")
        rows = written(rows.join(met, "key"), "rare-deviations")
        x = rows.filter("as_x").drop("as_x", "as_y")
        y = rows.filter("as_y").select("key", *[F.col(c).alias(f"_{c}") for c in ("place", "size", "id", "n", "component")])
        fit = (F.col("component") != F.col("_component")) & (F.least("n", "_n") * 100 >= F.greatest("n", "_n") * percent) & (
            F.least(F.col("size") - F.col("place"), F.col("_size") - F.col("_place")) * 2 * high
            >= (F.col("size") + F.col("_size")) * high - (F.col("n") + F.col("_n")) * low)
        return x.join(y, "key").filter(fit).select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()


def link_classes(docs: DataFrame, kept: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of the representatives that have a link."""
    members = kept.select("id", F.posexplode("bands").alias("band", "bucket"))
    order = F.xxhash64("id", F.pmod("band", F.lit(ORDERS)))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min_by("id", order).alias("first")).filter("n > 1")
    held = written(members.join(shared, "bucket").select("bucket", "id", "first", "n"), "buckets")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text"))
    linker = Linker(written(texts.join(held.select("id").distinct(), "id"), "bucket-texts"), kept, words, percent)
    links = linker.links(held.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")))
    found = components(links)
    # a bucket of two is done; in others, members that have not been compared may be of different components
    labelled = held.filter("n > 2 AND id <> first").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", F.coalesce("component", "id").alias("component"))
    unlike = labelled.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low < _high")
    left = written(held.join(unlike.select("bucket"), "bucket").select("bucket", "id"), "open")
    if not left.limit(1).count():
        return found
    # the member of a bucket with most links is its centre
    degrees = links.select("a").union(links.select("b")).groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    best = F.max_by("id", F.struct(F.coalesce("degree", F.lit(0)), -F.col("id")))
    centres = left.join(degrees, "id", "left").groupBy("bucket").agg(best.alias("a"))
    pairs = left.join(centres, "bucket").filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    apart = linker.deviations(pairs)
    near = F.size("keys") * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)
    links = links.union(apart.filter(near).select("a", "b"))
    found = components(links)
    apart = apart.join(found.withColumnRenamed("node", "b"), "b", "left").withColumn("component", F.coalesce("component", "b"))
    unlike = apart.groupBy("a").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low < _high")
    apart = written(apart.join(unlike.select("a"), "a"), "apart")
    return components(links.union(linker.links(linker.open_pairs(apart))))


def groups(docs: DataFrame, words: int = 2, percent: int = SIMILARITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept: one row per row of `docs`."""
    sketched = written(sketches(docs, words, id_col, text_col), "sketches")
    classes = sketched.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.min("id").alias("class_id"))
    # one row per class: that of its smallest id
    kept = written(sketched.join(classes.withColumnRenamed("class_id", "id"), ["set_key", "id"])
                   .select("id", "bands", "signature"), "classes")
    found = link_classes(docs, kept, words, percent, id_col, text_col)
    classes = classes.join(found.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "set_key", F.coalesce("component", "class_id").alias("_group"))
    out = sketched.select("id", "n_shingles", "set_key").join(classes, "set_key", "left")
    component = F.coalesce("_group", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = SIMILARITY, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose document is the first of its group, with all their columns."""
    gone = groups(docs, words, percent, id_col, text_col).filter("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
