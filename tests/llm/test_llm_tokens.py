"""Prefix BPE and packing against the public libraries."""

import hashlib
import random
import zlib
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_DIR
from tabularium.llm import prefix_bpe, window_packing
from tabularium.llm.queries import QUERIES

RANKS = prefix_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODER = prefix_bpe.PrefixEncoder(RANKS)
PUBLIC = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
    DEFINITION = f.read()
TOKENIZER = Tokenizer.from_str(DEFINITION)
PACKED = window_packing.Tokens(DEFINITION, public_tokenizers.PATTERN)
PARTS = ["a", "the", " ", "  ", "\n", "\t", "é", "1", "23", ".", "'s", "\0", "日本", "😀", "\r\n", "====", "\u00a0", "<|endoftext|>"]
texts = st.lists(st.sampled_from(PARTS), max_size=40).map("".join) | st.text(max_size=60)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_same_as_public_encoders(text):
    text = text.encode("utf-8", "ignore").decode()
    encoder = prefix_bpe.TextEncoder(ENCODER, public_tokenizers.PATTERN)
    ids = list(encoder.encode([text, text + " x"]))
    assert ids[0] == PUBLIC.encode_ordinary(text) and ids[1] == PUBLIC.encode_ordinary(text + " x")
    assert ENCODER.decode(ids[0]).decode() == text
    assert PACKED.encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_append_and_edit():
    rng = random.Random(5)
    for _ in range(300):
        piece = bytes(rng.choices(b"abetoinx \xc3\xa9", k=rng.randint(0, 300)))
        last = ENCODER.last_tokens(piece)
        assert ENCODER.walk_back(last) == (PUBLIC._core_bpe.encode_single_piece(piece) if piece else [])
        more = bytes(rng.choices(b"abetoinx", k=rng.randint(0, 20)))
        assert ENCODER.append(piece, last, more) == (piece + more, ENCODER.last_tokens(piece + more))
        at = rng.randint(0, len(piece))
        cut = rng.randint(0, min(5, len(piece) - at))
        new = piece[:at] + more + piece[at + cut:]
        assert ENCODER.edit(piece, last, at, cut, more) == (new, ENCODER.last_tokens(new))


def test_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op3_prefix_bpe"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = PUBLIC.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (3, " \n\t"), (None, "a b"), (4, "word " * 40_000), (5, "x" * 20_000)]
    return spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], "doc_id long, text string, ids string, `start` int")


def test_edges(spark):
    docs = edges(spark)
    got = prefix_bpe.decode(prefix_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert sorted((r.doc_id or 0, bytes(r.text_bytes)) for r in got) == sorted(
        (r.doc_id or 0, (r.text or "").encode()) for r in docs.collect())
    assert prefix_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def check_pieces(rows, docs, size=1024):
    """Every id of every document once, gapless windows; returns the share of padding."""
    want = {d: TOKENIZER.encode(t or "", add_special_tokens=False).ids + [0] for d, t in docs.items()}
    for d, ids in want.items():
        at = 0
        for r in sorted((r for r in rows if r.doc_id == d), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.crc == zlib.crc32(array("I", ids[r.start:at]).tobytes())
        assert at == len(ids)
    windows = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == windows.get(r.sequence_id, 0)
        windows[r.sequence_id] = r.offset + r.length
    assert max(windows.values(), default=0) <= size
    padded = sum(0 if n & (n - 1) == 0 else size - n for n in windows.values())
    return padded / max(1, sum(windows.values()))


def test_packing(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op10_window_packing"](spark, SF_DIR).withColumnRenamed("ids_crc32", "crc").collect()
    assert {r.doc_id for r in rows} == set(docs)
    assert check_pieces(rows, docs) < 0.01


def test_packing_edges(spark):
    docs = edges(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    from pyspark.sql import functions as F

    rows = window_packing.pack(docs, DEFINITION, public_tokenizers.PATTERN).withColumn("crc", F.crc32("ids")).collect()
    assert check_pieces(rows, {r.doc_id: r.text for r in docs.collect()}) < 0.01
    assert window_packing.pack(docs.limit(0), DEFINITION, public_tokenizers.PATTERN).collect() == []
    assert len(window_packing.pack(edges(spark), DEFINITION, public_tokenizers.PATTERN).filter("doc_id IS NULL").collect()) >= 1
    with pytest.raises(ValueError):
        window_packing.pack(docs, DEFINITION, public_tokenizers.PATTERN, size=1000)


def test_cuts_are_the_best():
    rng = random.Random(2)

    def cost_of(cuts, penalty, size):
        total, last = 0.0, 0
        for c in cuts:
            n = c - last
            total += penalty[c] + (0 if n & (n - 1) == 0 else size - n)
            last = c
        return total

    def least(at, penalty, size):
        best = {0: 0.0}
        for c in at:
            best[c] = min(best[i] + penalty[c] + (0 if (c - i) & (c - i - 1) == 0 else size - (c - i)) for i in best if c - i <= size)
        return best[at[-1]]

    for _ in range(200):
        at, here = [], 0
        while here < 120:
            here += rng.randint(1, 9)
            at.append(here)
        penalty = {c: rng.choice([0.0, 2.0, 6.0]) for c in at}
        cuts = window_packing.best_cuts(at, [penalty[c] for c in at], 16)
        assert cuts[-1] == at[-1] and abs(cost_of(cuts, penalty, 16) - least(at, penalty, 16)) < 1e-9


def test_rank_table_is_recognised():
    import json

    definition = json.loads(DEFINITION)
    assert window_packing.is_rank_table(definition)
    assert not window_packing.is_rank_table(definition | {"normalizer": {"type": "Lowercase"}})
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        assert not window_packing.is_rank_table(json.load(f))
