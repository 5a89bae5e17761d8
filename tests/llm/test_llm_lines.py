"""Line dedup against a brute force that uses nothing of the operator."""

from conftest import SF_DIR
from tabularium.llm import line_alignment


def long_lines(text):
    return [x for x in (y.strip(" \t\n\x0b\x0c\r") for y in text.split("\n")) if len(x) >= 20]


def check_no_line_stays(rows, texts):
    """A line of 20 characters stays in its first holder alone, and there as often as it was."""
    first = {}
    for k in sorted(texts):
        for x in long_lines(texts[k]):
            first.setdefault(x, k)
    for r in rows:
        assert long_lines(r.text) == [x for x in long_lines(texts[r.doc_id]) if first[x] == r.doc_id]


def removed(docs):
    return line_alignment.remove(docs).select("_row.doc_id", "text", "n_removed").collect()


def test_lines_that_occur_twice_or_cross(spark):
    a, b, c = ("line %s, long enough to count" % x for x in "abc")
    texts = {k: f"own line of document number {k}\n{a}\nx\n{a}\n{b}\n{c}" for k in range(12)}
    texts |= {20: f"{c}\ny\n{b}\n{a}\n{a}\nz\n{a}", 21: f"{b}\n{c}\nshort\n{b}\n{a}", 22: f"own\n{a}\nown line of document number 21"}
    rows = removed(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    check_no_line_stays(rows, texts)
    left = {r.doc_id: (r.n_removed, r.text) for r in rows}
    assert left[0] == (0, texts[0]) and left[20] == (5, "y\nz") and left[21] == (4, "short")


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").filter("text IS NOT NULL")
    check_no_line_stays(removed(docs), {r.doc_id: r.text for r in docs.collect()})
