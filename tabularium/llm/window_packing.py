"""Order-preserving packing of token sequences into windows.

Documents are read in their order, each followed by a separator id, as one stream; cutting the stream into windows packs
them. Windows end at document or sentence ends where that is cheap. The cuts minimise padding plus a penalty per cut by
dynamic programming over the candidate cuts: the best way to reach cut j is the least over earlier cuts i of
cost(i) + padding(j - i) + penalty(j). For windows padded to the full size the padding is size - (j - i), so the least
cost(i) + i among the cuts within reach is kept in a monotone queue; windows whose length is a power of two are not padded
and are looked up. Besides sentence ends, the multiples of the size in the stream are candidates, so no window need be
padded more than the penalty of cutting inside a sentence is worth, and at the end of a run the powers of two that the
rest is made of.

A run is the documents of one task up to `RUN_CHARS` characters; runs are independent, so nothing is shuffled, and a task
holds one run. Sequence ids hold the partition and a number; they repeat exactly if a task is run again.

Edge cases: a null or empty text is the separator alone. A very long text makes a run of its own and is cut as often as
needed. Repeated rows are packed each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 1024
AT_SENTENCE = 2.0  # penalty of a cut at a sentence end, in tokens of padding
INSIDE = 6.0  # penalty of any other cut inside a document
RUN_CHARS = 3_000_000


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokens:
    """Token ids of texts as a `tokenizers` file gives them, without special tokens added.

    A byte-level file without normalizer whose merges stand in the order of their ids is a table of ranks, and ranks are
    encoded an order of magnitude faster by `tiktoken`, to the same ids. Any other file, and a text that may hold the
    string of a special token, is encoded by `tokenizers` itself.
    """

    def __init__(self, definition: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith((".", "!", "?", "Ċ"))  # the last one stands for a line end
        self.ranked = None
        if is_rank_table(json.loads(definition)):
            import tiktoken

            alphabet, added = byte_alphabet(), set(self.special)
            ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items() if t not in added}
            self.ranked = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if self.ranked is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranked.encode_to_numpy(text, disallowed_special=())


def is_rank_table(definition: dict) -> bool:
    """True if encoding by merges and encoding by the rank of what a merge makes are the same thing."""
    model, cutter = definition["model"], definition.get("pre_tokenizer") or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges") or []]
    made = [model["vocab"]["".join(m)] for m in merges]
    return (model.get("type") == "BPE" and not definition.get("normalizer") and not model.get("dropout")
            and not model.get("ignore_merges") and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space") and all(a < b for a, b in zip(made, made[1:]))
            and len(made) + 256 == sum(t not in {x["content"] for x in definition.get("added_tokens") or []}
                                       for t in model["vocab"]))


def candidate_cuts(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, size: int, at_sentence: float,
                   inside: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, and what that costs."""
    total = len(ids)
    sentences = np.flatnonzero(ends[ids]) + 1
    marks = np.arange(size, total + 1, size)
    rest = np.array([total >> k << k for k in range(size.bit_length())])
    at = np.unique(np.concatenate([sentences, marks, rest[rest > 0], doc_ends]))
    cost = np.full(len(at), inside)
    cost[np.searchsorted(at, sentences)] = at_sentence
    cost[np.searchsorted(at, doc_ends)] = 0.0
    return at, cost


def best_cuts(at: list[int], penalty: list[float], size: int) -> list[int]:
    """The window ends with the least padding and penalties."""
    at, cost, came = [0, *at], [0.0], [0]
    number = {0: 0}
    powers = [1 << k for k in range(size.bit_length())]
    queue, values, head = [0], [0.0], 0  # cuts by rising cost + position
    for n in range(1, len(at)):
        here = at[n]
        while at[queue[head]] < here - size:
            head += 1
        best, source = values[head] + size - here, queue[head]
        for p in powers:
            i = number.get(here - p)
            if i is not None and cost[i] < best:
                best, source = cost[i], i
        best += penalty[n - 1]
        cost.append(best)
        came.append(source)
        number[here] = n
        value = best + here
        while len(queue) > head and values[-1] >= value:
            queue.pop()
            values.pop()
        queue.append(n)
        values.append(value)
    out, n = [], len(at) - 1
    while n:
        out.append(at[n])
        n = came[n]
    return out[::-1]


def pack(docs: DataFrame, definition: str, pattern: str, separator: int = 0, size: int = SIZE, at_sentence: float = AT_SENTENCE,
         inside: float = INSIDE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids (binary, 32-bit little-endian), doc_tokens, sequence_id, offset.

    `definition` is the text of a tokenizer file and `pattern` what cuts texts before its merges; `size` must be a power
    of two.
    """
    if size & (size - 1):
        raise ValueError("the window size must be a power of two")
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(zlib.compress(definition.encode()))
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(zlib.decompress(shared.value).decode(), pattern)
        first, used = TaskContext.get().partitionId() << 40, 0

        def packed(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
            nonlocal used
            last = np.array([separator], np.uint32)
            parts = [tokens.encode(t) for t in texts]
            lengths = np.array([len(p) + 1 for p in parts])
            ids = np.concatenate([x for p in parts for x in (p, last)])
            doc_ends = np.cumsum(lengths)
            at, penalty = candidate_cuts(ids, doc_ends, tokens.ends, size, at_sentence, inside)
            window_ends = np.array(best_cuts(at.tolist(), penalty.tolist(), size))
            stop = np.unique(np.concatenate([doc_ends, window_ends]))
            begin = np.concatenate([[0], stop[:-1]])
            doc, window = np.searchsorted(doc_ends, stop), np.searchsorted(window_ends, stop)
            window_begin = np.concatenate([[0], window_ends[:-1]])[window]
            bounds = pa.py_buffer(np.concatenate([[0], stop * 4]).astype(np.int32).tobytes())
            data = pa.BinaryArray.from_buffers(pa.binary(), len(stop), [None, bounds, pa.py_buffer(ids.tobytes())])
            out = pa.RecordBatch.from_arrays(
                [keys.take(pa.array(doc)), pa.array(begin - (doc_ends - lengths)[doc]), pa.array(stop - begin), data,
                 pa.array(lengths[doc]), pa.array(first + used + window), pa.array(begin - window_begin)], names)
            used += len(window_ends)
            return out

        keys, texts, held = [], [], 0
        for batch in batches:
            column = [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            for i, t in enumerate(column):
                texts.append(t)
                held += len(t)
                if held >= RUN_CHARS:
                    yield packed(pa.concat_arrays([*keys, batch.column(0).slice(at, i + 1 - at)]), texts)
                    keys, texts, held, at = [], [], 0, i + 1
            if at < len(column):
                keys.append(batch.column(0).slice(at))
        if texts:
            yield packed(pa.concat_arrays(keys), texts)

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long, "
                                "sequence_id long, offset long")
