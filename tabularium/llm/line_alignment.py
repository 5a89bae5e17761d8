"""Line dedup by pairwise alignment.

Documents overlap if they share a line of at least `LEAST_LINE` characters. A line leads each of its holders to the first
one (the smallest id); through a rare line, held by at most `RARE` documents, a holder also meets the one just before it.
So a line costs at most two pairs per holder however many hold it, and no line is left out. Every pair is aligned by
patience diff over line hashes: lines that occur once on both sides and rise together are anchors, and the parts between
them are aligned in the same way. Blocks of aligned lines are deleted from the later document if they hold a line of
`LEAST_LINE` characters. Such a line that has no place in the alignment, as it occurs twice or crosses another, is a
block of its own. So each goes from all documents but its first holder.

Only line hashes travel to the pairs; texts are moved once, to meet the deletions for them. A line that very many share
makes a hot side of a join, which adaptive execution splits, and is folded before any grouping.

Edge cases: lines are compared without ASCII white space at their ends. A null text stays null and has no lines, an empty
one has one blank line. A document of which all lines are deleted has an empty text. Rows with a null id take no part and
stay as they are; rows with the same id count as one document, are not compared with each other, and lose the same line
numbers. An empty table gives an empty result. `remove` keeps all columns of its input, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import written

LEAST_LINE = 20
RARE = 8


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, given by rising first member, whose second members rise too."""
    tails, at, before = [], [], []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        before.append(at[k - 1] if k else -1)
        tails[k:k + 1] = [j]
        at[k:k + 1] = [n]
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal lines, rising on both sides."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = rising([(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place])
        for (i, j), (k, m) in zip(anchors, [*anchors[1:], (a1, b1)]):
            todo.append((i, k, j, m))  # begins with its anchor, and takes on the equal lines that follow
        if anchors:
            todo.append((a0, anchors[0][0], b0, anchors[0][1]))
    return sorted(found)


def common_blocks(a: list[int], b: list[int], sizes: list[int], least: int) -> list[int]:
    """Line numbers of b in blocks, neighbours on both sides, that hold a line of `least` characters; other lines of
    `least` characters that a holds are blocks of one line."""
    held = set(a)
    out, block, last = {j for j, x in enumerate(b) if sizes[j] >= least and x in held}, [], None
    for i, j in [*patience(a, b), (-1, -1)]:
        if last is not None and (i, j) != (last[0] + 1, last[1] + 1):
            if max(sizes[x] for x in block) >= least:
                out.update(block)
            block = []
        block.append(j)
        last = (i, j)
    return sorted(out)


def deletions(docs: DataFrame, id_col: str, text_col: str, least: int = LEAST_LINE, rare: int = RARE) -> DataFrame:
    """(id, gone array<int>): the numbers of the deleted lines of each document that loses any."""
    lines = F.transform(lines_of(F.col(text_col)), bare)
    hashed = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), lines.alias("_lines")).select(
        "id", F.transform("_lines", lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform("_lines", lambda x: F.char_length(x)).alias("sizes"))
    hashed = written(hashed, "line-hashes")
    held = hashed.select("id", F.explode(F.arrays_zip("hashes", "sizes")).alias("x")).filter(
        F.col("x.sizes") >= least).select("id", F.col("x.hashes").alias("line"))
    folded = held.groupBy("line").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = folded.filter("first < last")
    holders = written(held.join(shared, "line").select("line", "id", "first", "n"), "line-holders")
    # at most `rare` rows to a line
    before = F.lag("id").over(Window.partitionBy("line").orderBy("id"))
    near = holders.filter(F.col("n") <= rare).select("id", before.alias("first"))
    pairs = holders.select("id", "first").union(near).filter("first < id").distinct()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, ids, gone = batch.slice(at, 256), [], []
                for n, (a, b, sizes) in enumerate(zip(*(part.column(c).to_pylist() for c in (1, 2, 3)))):
                    numbers = common_blocks(a, b, sizes, least)
                    ids += [n] * len(numbers)
                    gone += numbers
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(ids, pa.int64())), pa.array(gone, pa.int32())], ["id", "line_no"])

    earlier = hashed.select(F.col("id").alias("first"), F.col("hashes").alias("_a"))
    both = pairs.join(earlier, "first").join(hashed, "id").select("id", "_a", "hashes", "sizes")
    kind = hashed.schema["id"].dataType.simpleString()
    gone = both.mapInArrow(align, f"id {kind}, line_no int").distinct()
    return gone.groupBy("id").agg(F.collect_list("line_no").alias("gone"))  # the line numbers of one document


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LINE,
           rare: int = RARE) -> DataFrame:
    """_row (the input row), text without the deleted lines, n_lines, n_removed."""
    gone = written(deletions(docs, id_col, text_col, least, rare).withColumnsRenamed({"id": "_id", "gone": "_gone"}), "deletions")
    rows = docs.select(F.struct(F.col("*")).alias("_row"), F.col(id_col).alias("_key"))
    # the deletions grow with the table: the same plan at every size, none is broadcast
    met = rows.join(gone.hint("merge"), F.col("_key") == F.col("_id"), "left")
    text = F.col("_row").getField(text_col)
    met = met.select("_row", "_gone", lines_of(text).alias("_lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    return met.select(
        "_row", F.when(F.col("_gone").isNull(), text).otherwise(kept).alias("text"),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("long").alias("n_removed"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of `docs` with shorter texts; documents of which nothing but white space is left are gone."""
    done = remove(docs, id_col, text_col)
    left = done.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(*[F.col("text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c)
                         for c in docs.columns])
