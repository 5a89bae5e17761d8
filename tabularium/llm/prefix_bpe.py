"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that ends its encoding. Storing that token per prefix gives the
encoding by walking back from the end, an exact append (earlier prefixes do not change), and an exact re-encoding after an
edit (only prefixes near the edit change). The last token of a prefix is the one token t that ends it and whose
predecessor, the last token of what comes before t, forms a pair with t that the merges would leave apart.

A text is cut by the vocabulary's pattern and every match is encoded separately; encodings of pieces are kept in a bounded
memory per task. Vocabulary tables are broadcast; their size is the vocabulary's.

Edge cases: a null text is empty and encodes to no ids; repeated rows are encoded alike; an empty table gives an empty
result; columns other than the id and the text are ignored. Bytes that no token covers cannot occur: every single byte
must be in the vocabulary, which is checked.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT_CHUNKS = 200_000  # entries of the per-task memories
KEPT_PIECES = 200_000
KEPT_PAIRS = 300_000
BATCH_CHARS = 2_000_000  # characters encoded together, and ids decoded together


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id from a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"single bytes without a token: {missing}")
    return ranks


class PrefixEncoder:
    """The vocabulary and the pairs of tokens its merges leave apart."""

    def __init__(self, ranks: dict[bytes, int], halves: tuple[array, array] | None = None):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.left, self.right = array("i", range(len(self.tokens))), array("i", range(len(self.tokens)))
        if halves is None:
            self._find_halves()
        else:
            self.left, self.right = halves
            for t, (a, b) in enumerate(zip(self.left, self.right)):
                if len(self.tokens[t]) > 1:
                    self.merged[a, b] = t

    def _find_halves(self) -> None:
        """The two tokens each token is merged from: the one cut that the merges before it leave apart."""
        for t, token in enumerate(self.tokens):
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i], t), self.ranks.get(token[i:], t)
                if a < t and b < t and self._stay_apart(a, b):
                    self.left[t], self.right[t] = a, b
                    self.merged[a, b] = t
                    break

    def halves(self) -> tuple[array, array]:
        return self.left, self.right

    def _stay_apart(self, a: int, b: int) -> bool:
        """True if the bytes of a and b encode to [a, b].

        The merges are undone from the last one back. What is left at the seam of the two tokens must never have been
        mergeable before the merge that was just undone.
        """
        before = len(self.tokens)  # merges from this one on have been undone
        while True:
            if self.merged.get((a, b), before) < before:
                return False
            whole_a, whole_b = self.left[a] == a, self.left[b] == b
            if whole_a and whole_b:
                return True
            if whole_b or (not whole_a and a > b):
                before, a = a, self.right[a]
            else:
                before, b = b + 1, self.left[b]

    def last_tokens(self, piece: bytes, known: list[int] | None = None) -> list[int]:
        """The last token of every prefix, from length 0 (-1); `known` holds those of a shorter prefix."""
        last = known if known is not None else [-1]
        get, pairs, longest, add = self.ranks.get, self.pairs, self.longest, last.append
        for end in range(len(last), len(piece) + 1):
            for start in range(end - 1, -1 if end <= longest else end - longest - 1, -1):
                t = get(piece[start:end])
                if t is None:
                    continue
                if not start:
                    add(t)
                    break
                key = last[start] << 32 | t
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= KEPT_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self._stay_apart(last[start], t)
                if fits:
                    add(t)
                    break
        return last

    def walk_back(self, last: list[int]) -> list[int]:
        ids, end = [], len(last) - 1
        while end:
            ids.append(last[end])
            end -= len(self.tokens[last[end]])
        ids.reverse()
        return ids

    def encode(self, piece: bytes) -> list[int]:
        t = self.ranks.get(piece)
        if t is not None and (len(piece) == 1 or self.left[t] != t):
            return [t]
        return self.walk_back(self.last_tokens(piece))

    def append(self, piece: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """The piece and its last tokens after an append; only the new prefixes are worked out."""
        piece += more
        return piece, self.last_tokens(piece, list(last))

    def edit(self, piece: bytes, last: list[int], at: int, removed: int, inserted: bytes) -> tuple[bytes, list[int]]:
        """The piece and its last tokens after an edit.

        Prefixes before the edit stay. Behind it, once as many last tokens in a row as the longest token has bytes are
        what they were, so are all that follow.
        """
        new = piece[:at] + inserted + piece[at + removed:]
        tokens, shift, same = list(last[:at + 1]), len(inserted) - removed, 0
        for end in range(at + 1, len(new) + 1):
            self.last_tokens(new[:end] if end < len(new) else new, tokens)
            if end > at + len(inserted):
                same = same + 1 if tokens[end] == last[end - shift] else 0
                if same >= self.longest:
                    return new, tokens + last[end - shift + 1:]
        return new, tokens

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class TextEncoder:
    """Encodes texts in batches. Chunks between single spaces and line ends are looked up first.

    A single space before a non-space character starts a match of the pattern, and a line end between two non-space
    characters is a match; so such chunks can be encoded one by one. A chunk that is empty, or that begins (after one
    space) or ends with white space, marks a text to which this does not apply; it is cut by the pattern as a whole.
    Pieces that are new in a batch are encoded in sorted order, each as an append to the prefix it shares with the last.
    """

    def __init__(self, encoder: PrefixEncoder, pattern: str):
        self.encoder, self.find = encoder, regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes | None] = {}

    def _learn_pieces(self, wanted: set[str]) -> None:
        if len(self.pieces) + len(wanted) > KEPT_PIECES:
            self.pieces = {k: self.pieces[k] for k in wanted.intersection(self.pieces)}
        before, last, walk = b"", [-1], self.encoder.walk_back
        for text in sorted(wanted.difference(self.pieces)):
            piece, shared = text.encode(), 0
            for x, y in zip(piece, before):
                if x != y:
                    break
                shared += 1
            del last[shared + 1:]
            self.encoder.last_tokens(piece, last)
            self.pieces[text] = array("I", walk(last)).tobytes()
            before = piece

    def _learn_chunks(self, wanted: set[str]) -> None:
        if len(self.chunks) + len(wanted) > KEPT_CHUNKS:
            self.chunks = {k: self.chunks[k] for k in wanted.intersection(self.chunks)}
        cut: dict[str, list[str]] = {}
        for chunk in wanted.difference(self.chunks):
            body = chunk[1:] if chunk[:1] == " " else chunk
            if chunk != "\n" and (not body or body[0].isspace() or body[-1].isspace()):
                self.chunks[chunk] = None
            else:
                cut[chunk] = self.find(chunk)
        self._learn_pieces(set(chain.from_iterable(cut.values())))
        get = self.pieces.__getitem__
        for chunk, pieces in cut.items():
            self.chunks[chunk] = get(pieces[0]) if len(pieces) == 1 else b"".join(map(get, pieces))

    def _whole(self, text: str) -> bytes:
        pieces = self.find(text)
        self._learn_pieces(set(pieces))
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        return (array("I", ids).tolist() for ids in self.packed(texts))

    def packed(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as unsigned 32-bit integers."""
        cut = [t.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if t and "\0" not in t else None
               for t in texts]
        self._learn_chunks(set(chain.from_iterable(filter(None, cut))))
        for text, chunks in zip(texts, cut):
            found = list(map(self.chunks.__getitem__, chunks)) if chunks else [None]
            yield (self._whole(text) if text else b"") if None in found else b"".join(found)


def slices(sizes: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Start and length of runs of rows that add up to about `most`; a larger row is a run of its own."""
    start, held = 0, 0
    for i, size in enumerate(sizes.to_pylist()):
        held += size or 0
        if held >= most:
            yield start, i + 1 - start
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes) - start


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (binary, little-endian unsigned 32-bit token ids) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, PrefixEncoder(ranks).halves()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = TextEncoder(PrefixEncoder(*shared.value), pattern)
        for batch in batches:
            for at, n in slices(pc.utf8_length(batch.column(1)), BATCH_CHARS):
                part = batch.slice(at, n)
                ids = list(texts.packed([t or "" for t in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], [id_col, "ids"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id") -> DataFrame:
    """The columns of `encode` with text_bytes (binary) and digits (binary: decimal ids joined by one space)."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(shared.value.values()) + 1
        tokens, digits = [b""] * size, [str(i).encode() for i in range(size)]
        for token, rank in shared.value.items():
            tokens[rank] = token
        for batch in batches:
            for at, n in slices(pc.binary_length(batch.column(1)), 4 * BATCH_CHARS):
                part, whole, decimal = batch.slice(at, n), [], []
                for x in part.column(1).to_pylist():
                    ids = np.frombuffer(x, "<u4").tolist()
                    whole.append(b"".join(map(tokens.__getitem__, ids)))
                    decimal.append(b" ".join(map(digits.__getitem__, ids)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(whole, pa.binary()), pa.array(decimal, pa.binary())],
                    [id_col, "ids", "text_bytes", "digits"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, ids binary, text_bytes binary, digits binary")
