"""Texts folded whole, held against unicodedata."""

import hashlib
import unicodedata

from conftest import SF_DIR
from tabularium.catalog import load_all
from tabularium.functions import udfs


def folded(text):
    return None if text is None else "".join(c for c in unicodedata.normalize("NFKD", text) if not "\u0300" <= c <= "\u036f")


def test_letters(spark):
    rows = [(1, "Käse über Öl, Straße"), (2, "x" * 60 + " café niño"), (3, None), (4, ""), (5, "ﬁn ½ Å"), (6, "o\u0308")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(map(tuple, frame.select("doc_id", udfs.folded_letters("text")).collect()))
    assert got == {k: folded(t) for k, t in rows}
    assert got[1] == "Kase uber Ol, Straße" and got[2].endswith("cafe nino")


def test_every_document_is_folded_whole(spark):
    texts = {r.doc_id: folded(r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    got = load_all()["x3_whole_documents"](spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id]
        assert (r.n_chars, r.folded_sha256) == ((None, None) if t is None else (len(t), hashlib.sha256(t.encode()).hexdigest()))
