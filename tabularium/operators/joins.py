"""Joins beyond a plain `df.join`.

Equi-joins of a large and a keyed side are left to Catalyst: adaptive execution
broadcasts a side only after measuring it and splits skewed partitions. The functions
here cover what needs more than that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators import ordered
from tabularium.operators.grouping import spread_salt, with_group_agg
from tabularium.session import written
from tabularium.sources import storage


def nullsafe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for i, k in enumerate(keys):
        same = left[k].eqNullSafe(right[k])
        on = same if i == 0 else on & same
    return on


def preagg_join(master: DataFrame, detail: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Fold the detail to the key of the master before joining, so that no master row multiplies."""
    return master.join(detail.groupBy(*keys).agg(*aggs), list(keys), "left")


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows with a match, each once. Right keys are folded first: a hot one is shuffled once per task."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a match; NULL keys on the right match nothing and do not empty the result."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def bucketed_join(left: DataFrame, right: DataFrame, key: str, buckets: int | None = None,
                  bucket_rows: int = storage.BUCKET_ROWS) -> DataFrame:
    """Inner join of two sides written to tables with the same buckets, which needs no shuffle.

    A bucket is read by one task, so this is for keys without hot values: a key with more
    than `bucket_rows` rows is refused (use `salted_join`). Without `buckets`, their number
    follows from the larger side.
    """
    n = buckets or max(storage.buckets_for(left, bucket_rows), storage.buckets_for(right, bucket_rows))
    return storage.write_bucketed(left, key, n, bucket_rows).join(storage.write_bucketed(right, key, n, bucket_rows), key)


def full_join_match(left: DataFrame, right: DataFrame, key: str, left_label: str, right_label: str) -> DataFrame:
    """Full join with `match_type`: both, only left, only right. Each side has unique keys."""
    a = left.withColumn("_in_left", F.lit(True))
    b = right.withColumn("_in_right", F.lit(True))
    kind = (F.when(F.col("_in_left").isNull(), right_label).when(F.col("_in_right").isNull(), left_label)
            .otherwise("both"))
    return a.join(b, key, "full").withColumn("match_type", kind).drop("_in_left", "_in_right")


def hinted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], hint: str, how: str = "inner") -> DataFrame:
    """Join with an asked-for strategy (`merge`, `shuffle_hash`, `broadcast`)."""
    if hint not in ("merge", "shuffle_hash", "broadcast"):
        raise ValueError(f"unknown join hint {hint}")
    return left.join(right.hint(hint), list(keys), how)


def broadcast_checked(big: DataFrame, small: DataFrame, keys: Sequence[str], max_bytes: int = 64 << 20,
                      how: str = "inner") -> DataFrame:
    """Broadcast `small` only when it is measured to be at most `max_bytes` of text; else a shuffled join."""
    size = small.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size <= max_bytes:
        return big.join(F.broadcast(small), list(keys), how)
    return big.join(small, list(keys), how)


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int = 16, hot_share: float = 0.01) -> DataFrame:
    """N:1 inner join that spreads hot keys of `big` over `salts` partitions.

    A key is hot when it holds more than `hot_share` of the rows, so there are at most
    1 / hot_share hot keys, which is what makes their broadcast safe. They are written, so
    that both sides see the same ones. Only the hot rows of `small` are repeated.
    """
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    limit = counts.select(key, "_n").filter(F.col("_n") > total.scalar() * F.lit(hot_share))
    hot = F.broadcast(written(limit.select(key, F.lit(True).alias("_hot")), "hot-keys"))
    hashable = [f.name for f in big.schema.fields if "map<" not in f.dataType.simpleString()]
    left = big.withColumn("_spread", spread_salt(salts, *hashable)).join(hot, key, "left")
    left = left.withColumn("_salt", F.when(F.col("_hot"), F.col("_spread")).otherwise(0)).drop("_hot", "_spread")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_salt"]).drop("_salt")


def join_cardinality(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows a join on `key` would give, for keys that repeat on both sides."""
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("left_rows")).filter("left_rows > 1")
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("right_rows")).filter("right_rows > 1")
    return a.join(b, key).withColumn("joined_rows", F.col("left_rows") * F.col("right_rows"))


LEVELS = 40  # halvings of the segments of one key: room for 2**40 of them


def disjoint_versions(dim: DataFrame, key: str, valid_from: str, valid_to: str, attrs: Sequence[str],
                      max_group: int = ordered.MAX_GROUP_ROWS) -> DataFrame:
    """Versions cut so that at most one is valid at any time: of several, the one that began last; then the longer one.

    Keys whose versions follow each other stay as they are. For the others every start and end is a cut, and the pieces
    between cuts are numbered per key. A version covers a run of pieces, which is put together from at most two dyadic
    blocks per level; per block the best version is kept, and a piece takes the best of the blocks it lies in. So a key
    with m versions costs m log m rows that are folded by (key, block), never all of its rows in one task. Versions that
    end before they begin, and NULL keys or starts, are left out.

    What is joined here grows with the versions and packs into small files, from whose size Spark would take it for small
    enough to broadcast; so these joins are merges.
    """
    end = F.col(valid_to)
    own = dim.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull() & (end.isNull() | (end > F.col(valid_from))))
    own = own.select(key, valid_from, valid_to, *[a for a in attrs if a not in (key, valid_from, valid_to)])
    order = [F.col(valid_from).asc(), end.asc_nulls_last()]
    following = ordered.scan(own.select(key, valid_from, valid_to), [key], order, ordered.lead("_next", F.col(valid_from)), max_group=max_group)
    crossed = following.filter(F.col("_next").isNotNull() & (end.isNull() | (F.col("_next") < end))).select(key)
    if not crossed.limit(1).count():
        return own
    crossed = written(crossed.distinct(), "crossed-keys")

    plain, rest = [hinted_join(own, crossed, [key], "merge", how) for how in ("left_anti", "left_semi")]
    cuts = rest.select(key, F.explode(F.array_distinct(F.array_compact(F.array(valid_from, valid_to)))).alias("_at")).distinct()
    pieces = ordered.scan(cuts, [key], [F.col("_at").asc()], ordered.row_number("_n"), ordered.lead("_until", F.col("_at")), max_group=max_group)
    pieces = written(pieces.select(key, "_at", "_until", (F.col("_n") - 1).alias("_n")), "pieces")
    size = pieces.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_size"))

    best = F.struct(F.col(valid_from).alias("at"), end.isNull().alias("open"), end.alias("until"), F.xxhash64(*attrs).alias("tie"))
    runs = rest.select(key, best.alias("_best"), F.struct(*attrs).alias("_attrs"))
    first, last = [pieces.select(F.col(key).alias(f"_k{i}"), F.col("_at").alias(f"_at{i}"), F.col("_n").alias(f"_n{i}")) for i in (0, 1)]
    runs = runs.join(first.hint("merge"), (F.col(key) == F.col("_k0")) & (F.col("_best.at") == F.col("_at0")))
    runs = runs.join(last.hint("merge"), (F.col(key) == F.col("_k1")) & (F.col("_best.until") == F.col("_at1")), "left")
    runs = runs.join(size.hint("merge"), F.col(key) == F.col("_k")).withColumn("_hi", F.coalesce("_n1", "_size"))

    def blocks(level: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low, high = (F.call_function("shiftright", c, level) for c in (F.col("_n0") + step - 1, F.col("_hi")))
        left, right = (low < high) & (low % 2 == 1), (low < high) & (high % 2 == 1)
        return F.array_compact(F.array(
            F.when(left, F.struct(level.alias("level"), low.alias("block"))),
            F.when(right, F.struct(level.alias("level"), (high - 1).alias("block")))))

    levels = F.sequence(F.lit(0), F.lit(LEVELS))
    covered = runs.select(key, "_best", "_attrs", F.inline(F.flatten(F.transform(levels, blocks))))
    covered = covered.groupBy(key, "level", "block").agg(F.max("_best").alias("_best"), F.max_by("_attrs", "_best").alias("_attrs"))

    up = F.sequence(F.lit(0), F.least(F.ceil(F.log2(F.col("_size"))).cast("int") + 1, F.lit(LEVELS)))
    chains = pieces.join(size.hint("merge"), F.col(key) == F.col("_k")).select(key, "_at", "_until", "_n", F.explode(up).alias("level"))
    chains = chains.withColumn("block", F.expr("shiftright(_n, level)"))
    won = hinted_join(chains, covered, [key, "level", "block"], "merge").groupBy(key, "_at", "_until").agg(F.max_by("_attrs", "_best").alias("_attrs"))
    cut = won.select(F.col(key), F.col("_at").alias(valid_from), F.col("_until").alias(valid_to),
                     *[F.col("_attrs")[a].alias(a) for a in own.columns if a not in (key, valid_from, valid_to)])
    return plain.unionByName(cut)


def asof_join(fact: DataFrame, dim: DataFrame, key: str, at: str, valid_from: str, valid_to: str | None,
              attrs: Sequence[str], tie: Sequence[str], how: str = "inner",
              max_group: int = ordered.MAX_GROUP_ROWS) -> DataFrame:
    """The version of `dim` valid at `fact[at]`: valid_from <= at < valid_to (open when NULL).

    Facts and versions are put in one time order per key and the last version is carried
    forward, so a key with many facts and many versions gives no pairs. `tie` identifies a
    fact among those of one key and time. A NULL key matches nothing. Where versions of a key
    overlap, the one that began last counts, and the longer of two that began together.
    """
    if valid_to is not None:
        own = dim.select(*dict.fromkeys([key, valid_from, valid_to, *attrs]))
        dim = disjoint_versions(own, key, valid_from, valid_to, list(attrs), max_group)
        until = F.col(valid_to)
    else:
        until = F.lit(None).cast(dim.schema[valid_from].dataType)
    version = F.struct(until.alias("until"), *attrs)
    facts = fact.select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*fact.columns).alias("_fact"), F.lit(None).cast(dim.select(version).schema[0].dataType).alias("_dim"),
    )
    versions = dim.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(facts.schema["_fact"].dataType).alias("_fact"), version.alias("_dim"),
    )
    order = [F.col("_at").asc(), F.col("_kind").asc(), F.col("_dim.until").asc_nulls_last(), *[F.col("_fact")[c].asc() for c in tie]]
    known = ordered.scan(versions.unionByName(facts), ["_key"], order, ordered.last_known("_found", F.col("_dim")), max_group=max_group)
    out = known.filter("_kind = 1").withColumn(
        "_found", F.when(F.col("_found.until").isNull() | (F.col("_at") < F.col("_found.until")), F.col("_found"))
    )
    if how == "inner":
        out = out.filter(F.col("_found").isNotNull())
    return out.select("_fact.*", *[F.col("_found")[a].alias(a) for a in attrs])


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of 6371 km."""
    half_lat = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    half_lon = F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 6371 * 2 * F.asin(F.sqrt(half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon))


def later_partners(df: DataFrame, group: str, key: str) -> DataFrame:
    """Pairs without mirror copies, in linear space.

    For each row: the next row of its group in key order, and how many pairs (row, later row)
    it opens. Listing every pair would grow with the square of a group.
    """
    rows = ordered.scan(df, [group], [F.col(key).asc()], ordered.row_number("_rn"), ordered.lead("next_partner", F.col(key)))
    sized = with_group_agg(rows, [group], {"_size": F.count(F.lit(1))})
    return sized.withColumn("later_partners", F.col("_size") - F.col("_rn")).drop("_rn", "_size")


def period_join(facts: DataFrame, periods: DataFrame, at: str, start: str, tie: Sequence[str],
                max_group: int = ordered.MAX_GROUP_ROWS) -> DataFrame:
    """Each fact with the period it falls in: start <= at < the next start, for starts at any distance.

    Facts before the first start, and facts without a time, are left out. Facts and starts are put in one order
    and the last start is carried forward, so no pair of a fact and a period is tried.
    """
    one = F.lit(0).alias("_all")
    found = asof_join(facts.filter(F.col(at).isNotNull()).select(one, "*"),
                      periods.select(one, F.col(start), F.col(start).alias("_from")), "_all", at, "_from", None, [start],
                      tie, max_group=max_group)
    return found.drop("_all")
