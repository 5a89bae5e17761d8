"""The pipeline and its stages."""

import corpus_pipeline
from conftest import SF_DIR
from test_llm_documents import brute_groups, brute_spans
from test_llm_tokens import check_pieces
from pyspark.sql import functions as F
from tabularium.session import written


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("kept", F.lit("clash"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF_DIR), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
            ids = {r.doc_id for r in before.select("doc_id").collect()}
            assert {r.doc_id for r in docs.select("doc_id").collect()} <= ids
    texts = {r.doc_id: r.text for r in seen["line_dedup"].collect()}
    kept = {k for k, _, _, ok in brute_groups(texts, 5) if ok}
    assert {r.doc_id for r in seen["near_dedup"].collect()} == kept
    final = {r.doc_id: r.text for r in seen["secret_scan"].collect()}
    assert not any(brute_spans(t) for t in final.values())
    assert all(r.n_chars == len(r.text) for r in seen["secret_scan"].collect())
    assert check_pieces(seen["packing"].withColumn("crc", F.crc32("ids")).collect(), final) < 0.01


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 0


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), name)
    assert docs.count() == 0


def test_edges_of_every_stage(spark):
    prose = "The quick brown fox walks over the hill and looks at the river below. Nobody knows why it does so."
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None, "en", 0), (2, "", None, 0), (3, "  \n", "en", None), (4, prose, "en", 5), (4, prose, "en", 5), (5, prose, "en", 5),
            (6, long, None, 1), (7, long, "en", 1), (8, "password = hunter2hunter2 stands in this text about ships, sails, ropes and harbours.", "de", None),
            (None, "A text without an id that says something of its own about gardens, trees, apples and bees.", None, None)]
    docs = spark.createDataFrame([(*r, "x", 1, r[1]) for r in rows],
                                 "doc_id long, text string, lang string, n_chars long, line string, rank int, source string")
    out = {name: stage(spark, docs, SF_DIR).collect() for name, stage in corpus_pipeline.STAGES}
    ids = {name: sorted((r.doc_id or 0) for r in got) for name, got in out.items()}
    for name, got in list(out.items())[:-1]:
        assert got[0].__fields__ == docs.columns
        assert all((r.line, r.rank) == ("x", 1) for r in got)
    assert not {1, 2, 3} & set(ids["quality_rules"]) and {0, 6, 7, 8} <= set(ids["quality_rules"])
    assert ids["line_dedup"] == [0, 1, 2, 3, 4, 4, 6, 8] and ids["near_dedup"] == [0, 1, 2, 3, 4, 4, 6, 8]
    assert ids["secret_scan"] == sorted(r[0] or 0 for r in rows)
    secret = {r.doc_id: r.text for r in out["secret_scan"]}
    assert "hunter2" not in secret[8] and secret[1] is None and secret[4] == prose and secret[6] == long
    tokens = {}
    for r in out["packing"]:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens[1] == tokens[2] == 1 and tokens[4] == 2 * tokens[5] and tokens[6] == tokens[7] > 60_000
