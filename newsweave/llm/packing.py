"""Operator 4: cost-balanced packing of documents into training sequences.

The cost of a piece of n tokens is estimated as ``linear * n + quadratic * n^2`` (matrix
products and attention inside the piece). Documents are tokenised and packed in one pass:
each task gathers groups of about ``group_tokens`` tokens, so nothing is shuffled, memory is
bounded, and a lost task is simply run again on the same rows.

In a group, documents longer than a sequence are cut into full sequences first. The rest is
assigned in descending length, each to the lowest-cost sequence with enough room; if none has
enough room, the document is cut and fills the lowest-cost sequence that has any. The group's
sequences together have exactly the capacity of its tokens: as many of ``capacity`` as fit,
the remainder as powers of two, which need no padding. So a group is packed without padding.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import BoundedCache

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


#: A split pattern for lower-case printable ASCII that many word tokenizers share; used only
#: where it gives what the tokenizer gives (``WordEncoder._agrees``).
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PLAIN = re.compile(rb"[!-~]+")
_PROBE = "One two  three\n\n4 5\té à\r\n漢字 😀 ( x ) it 's".encode()


class WordEncoder:
    """Ids of a tokenizer. Where the tokenizer drops white space and never matches across it,
    words between ASCII blanks are encoded separately and memoised; other tokenizers get whole
    texts. Strings of special tokens give the ids of these tokens, as in the tokenizer itself."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.end = np.array([end_id], "<u4").tobytes()
        self.model = self.tok.model
        self.parts = BoundedCache(self._part, 400_000)
        self.memo = BoundedCache(self._one, 800_000)
        self.plain = True
        self.plain = self._agrees()
        self.by_words = not any(s.split() != [s] for s in self.special) and self._whole(_PROBE) == b"".join(map(self._whole, _PROBE.split()))

    def _agrees(self) -> bool:
        """Whether printable ASCII words may go to the merge model part by part."""
        chars = [chr(c) for c in range(33, 127)]
        probes = [a + b for a in chars for b in chars] + ["don't", "WE'LL", "a1b22", "x--y", "'S't"]
        try:
            return all(self._one(p.encode()) == self._whole(p.encode()) for p in probes)
        except Exception:  # a model without such a method or vocabulary
            return False

    def _whole(self, text: bytes) -> bytes:
        ids = self.tok.encode(text.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _one(self, word: bytes) -> bytes:
        if self.plain and _PLAIN.fullmatch(word) and not any(s in word for s in self.special):
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(word.lower().decode())))
        return self._whole(word)

    def _part(self, part: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        data = text.encode("utf-8", "surrogatepass") if text else b""
        if not self.by_words:
            return self._whole(data) + self.end
        words = data.split()
        return b"".join(map(self.memo.__getitem__, words)) + self.end


@lru_cache(maxsize=2)
def word_encoder(path: str, end_id: int) -> WordEncoder:
    return WordEncoder(path, end_id)


def pack_lengths(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for documents of these lengths; sequences
    are numbered from 0. Ties go to the earlier document and the lower sequence."""
    cost = lambda n: linear * n + quadratic * n * n
    out, rest, n_seq = [], [], 0
    for d, n in enumerate(lengths):
        at = 0
        while n - at >= capacity:
            out.append((d, at, capacity, n_seq, 0))
            at, n_seq = at + capacity, n_seq + 1
        if at < n:
            rest.append((at - n, d, at))  # longest first
    total = -sum(r[0] for r in rest)
    room = [capacity] * (total // capacity)
    room += [1 << k for k in range(capacity.bit_length() - 1, -1, -1) if (total % capacity) >> k & 1]
    size, left = list(room), np.array(room, np.int64)
    load = np.zeros(len(room))
    heapq.heapify(rest)
    while rest:
        minus, d, at = heapq.heappop(rest)
        n = -minus
        fits = np.flatnonzero(left >= n)
        if not len(fits):
            fits = np.flatnonzero(left > 0)
        s = int(fits[np.argmin(load[fits])])
        take = min(n, int(left[s]))
        out.append((d, at, take, n_seq + s, size[s] - int(left[s])))
        left[s] -= take
        load[s] += cost(take)
        if take < n:
            heapq.heappush(rest, (take - n, d, at + take))
    return out


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = 4096, linear: float = 1.0, quadratic: float = 1 / 4096,
         group_tokens: int = 1_000_000, text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (tokens of its document before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every document, also a null or empty one, ends with ``end_id`` and so has a piece; rows
    with the same doc_id are packed as separate documents; a null doc_id stays null; other
    columns are not read. An empty table gives no rows. sequence_id is unique in a run: the
    partition number in the upper bits, a counter below. A group is the unit of memory: at
    most ``group_tokens`` tokens and the document that crosses that number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(path, end_id)
        base = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        tokens = n_seq = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, tokens, n_seq
            parts = pack_lengths([len(x) // 4 for _, x in held], capacity, linear, quadratic)
            cols = ([held[d][0] for d, *_ in parts], [p[1] for p in parts], [p[2] for p in parts],
                    [held[d][1][4 * at:4 * (at + n)] for d, at, n, *_ in parts], [len(held[d][1]) // 4 for d, *_ in parts],
                    [base + n_seq + p[3] for p in parts], [p[4] for p in parts])
            n_seq += 1 + max(p[3] for p in parts)
            held, tokens = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 3 else pa.int64()) for k, c in enumerate(cols)],
                                              ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.encode(text)
                held.append((doc_id, ids))
                tokens += len(ids) // 4
                if tokens >= group_tokens:
                    yield flush()
        if held:
            yield flush()
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, PIECES)
