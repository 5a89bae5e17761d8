"""Line dedup drops a document only when no word of it is left."""

from tabularium.llm import line_alignment


def test_what_no_other_document_holds_stays(spark):
    popular = [f"popular line number {i}, of some length" for i in range(40)]
    texts = {1: "\n".join(popular[:20]), 2: "\n".join(popular[20:]), 3: "\n".join([*popular, "found nowhere else, this line"]),
             4: "\n".join([*popular, "yes"]), 5: "\n".join(popular), 6: " ", 7: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    left = dict(map(tuple, line_alignment.dedup(docs).collect()))
    assert left == {1: texts[1], 2: texts[2], 3: "found nowhere else, this line", 4: "yes", 6: " ", 7: None}
