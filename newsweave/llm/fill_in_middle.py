"""Operator 12: fill-in-middle transformation with a piece table.

A record batch has two immutable buffers: the UTF-8 bytes of its texts, as Arrow holds them, and
the sentinels. A document is a list of descriptors (buffer, start, length). Cutting splits a
descriptor at code points, an arrangement permutes the three parts and puts a sentinel before
each, the inverse permutation restores the text. Hashes take the bytes of the descriptors one
after another, so no arranged text is ever copied to be hashed.

Where a document is cut and which form it takes follows from the sha256 of ``seed:doc_id`` alone,
so every task, retry and run decides alike. Each row is handled by itself: nothing is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

SENTINELS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Buffers of the piece table.
TEXT, MARKS = 0, 1
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
#: Which part stands in which place of an arrangement, and the sentinel of each part.
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
SENTINEL_OF = {PREFIX: "<P>", SUFFIX: "<S>", MIDDLE: "<M>"}
_MARKS = "".join(SENTINELS).encode()
_MARK_AT = {part: (MARKS, _MARKS.index(s.encode()), len(s)) for part, s in SENTINEL_OF.items()}
#: Bytes looked at in one step when a code point is searched.
STEP = 1 << 16

Piece = tuple[int, int, int]


def byte_at(data: np.ndarray, k: int) -> int:
    """Byte offset of code point ``k`` of UTF-8 bytes; their length if there are just ``k``."""
    for start in range(0, len(data), STEP):
        lead = (data[start:start + STEP] & 0xC0) != 0x80
        n = int(np.count_nonzero(lead))
        if k < n:
            return start + int(np.flatnonzero(lead)[k])
        k -= n
    return len(data)


class PieceTable:
    """The buffers of one column of texts and descriptors over them."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        self.n = pc.utf8_length(texts).to_pylist()
        self.at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        self.buffers = (memoryview(self.data), memoryview(_MARKS))

    def whole(self, i: int) -> list[Piece]:
        return [(TEXT, int(self.at[i]), int(self.at[i + 1] - self.at[i]))]

    def cut(self, i: int, *places: int) -> list[Piece]:
        """Document ``i`` split at ascending code points."""
        (buffer, start, length), = self.whole(i)
        bounds = [0]
        for k in places:
            bounds.append(k if length == self.n[i] else byte_at(self.data[start:start + length], k))
        bounds.append(length)
        return [(buffer, start + a, b - a) for a, b in zip(bounds, bounds[1:])]

    def find(self, i: int, mark: str, after: int) -> int:
        """Byte offset in document ``i`` of the first ``mark`` at or behind ``after``."""
        start, stop = int(self.at[i]), int(self.at[i + 1])
        return bytes(self.buffers[TEXT][start + after:stop]).index(mark.encode()) + after

    def sha256(self, pieces: list[Piece]) -> str:
        h = hashlib.sha256()
        for buffer, start, length in pieces:
            h.update(self.buffers[buffer][start:start + length])
        return h.hexdigest()

    def text(self, pieces: list[Piece]) -> str:
        return b"".join(self.buffers[b][s:s + n] for b, s, n in pieces).decode("utf-8")


def arrange(parts: list[Piece], form: str) -> list[Piece]:
    """The three parts in the order of ``form``, a sentinel before each."""
    return [p for part in ORDER[form] for p in (_MARK_AT[part], parts[part])]


def restored(pieces: list[Piece], form: str) -> list[Piece]:
    """Inverse permutation of an arrangement, without its sentinels."""
    if form == PLAIN:
        return pieces
    content = [p for p in pieces if p[0] == TEXT]
    return [content[ORDER[form].index(part)] for part in (PREFIX, MIDDLE, SUFFIX)]


def choose(key: str, n: int, marked: bool, plain_percent: int, spm_percent: int) -> tuple[str, int, int]:
    """(form, end of prefix, end of middle) of a text of ``n`` code points."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or marked or h3 % 100 >= 100 - plain_percent:
        return PLAIN, 0, 0
    return (SPM if h4 % 100 < spm_percent else PSM), a, b


def _plan(b: pa.RecordBatch, seed: int, plain_percent: int, spm_percent: int):
    """(table, rows): the piece table of a batch (id, text) and per document its form, the
    lengths of prefix and middle, and its arranged pieces."""
    table = PieceTable(b.column(1))
    text = b.column(1)
    marked = np.zeros(len(text), bool)
    for s in SENTINELS:
        marked |= np.asarray(pc.fill_null(pc.match_substring(text, s), False).to_numpy(zero_copy_only=False), bool)
    rows = []
    for i, doc in enumerate(b.column(0).to_pylist()):
        form, a, z = choose(f"{seed}:{'' if doc is None else doc}", table.n[i], bool(marked[i]), plain_percent, spm_percent)
        rows.append((form, None, None, table.whole(i)) if form == PLAIN else (form, a, z - a, arrange(table.cut(i, a, z), form)))
    return table, rows


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def _id_type(docs: DataFrame, id_col: str) -> str:
    return docs.select(docs[id_col]).schema[0].dataType.simpleString()


def transform(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per row of ``docs``.

    A null text counts as empty. Empty texts and texts that contain a sentinel stay plain (their
    prefix_chars and middle_chars are null), so that every output can be restored. A null id is
    hashed as an empty one. Repeated rows give equal rows, an empty table stays empty; texts of
    any length are cut as a whole; other columns of ``docs`` are not read.
    """
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        table, rows = _plan(b, seed, plain_percent, spm_percent)
        form, prefix, middle, pieces = zip(*rows)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(table.n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                                           pa.array([table.text(p) for p in pieces], pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return map_batches(_source(docs, id_col, text_col), run, f"doc_id {_id_type(docs, id_col)}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(outputs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) of rows (doc_id, form, output) of ``transform``: the sentinels are found in
    the output (its text holds no other), which becomes descriptors for the inverse permutation.
    A null output is an empty text."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        table, texts = PieceTable(b.column(2)), []
        for i, form in enumerate(b.column(1).to_pylist()):
            pieces = table.whole(i)
            if form != PLAIN:
                (_, start, length), ends, at = pieces[0], [], 0
                for part in ORDER[form]:
                    at = table.find(i, SENTINEL_OF[part], at)
                    ends.append((at, at + len(SENTINEL_OF[part])))
                    at = ends[-1][1]
                stops = [a for a, _ in ends[1:]] + [length]
                pieces = [(TEXT, start + a, z - a) for (_, a), z in zip(ends, stops)]
            texts.append(table.text(restored(pieces, form)))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return map_batches(outputs.select(outputs[id_col].alias("doc_id"), "form", "output"), run, f"doc_id {_id_type(outputs, id_col)}, text string")


def digests(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``transform``, with the sha256 of the output and of the text restored from the output's
    descriptors and form in place of the output; both stream the descriptors."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        table, rows = _plan(b, seed, plain_percent, spm_percent)
        form, prefix, middle, pieces = zip(*rows)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(table.n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                                           pa.array([table.sha256(p) for p in pieces]), pa.array([table.sha256(restored(p, f)) for p, f in zip(pieces, form)])],
                                          ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])
    return map_batches(_source(docs, id_col, text_col), run, f"doc_id {_id_type(docs, id_col)}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


#: The query's rows in SQL: cut, arranged, and restored from output and form.
SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
u AS (SELECT *, length(text) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
v AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
w AS (SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, z - a) AS m, substring(text, z + 1, n - z) AS s FROM v),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
  ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM w)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substring(output, 4, strpos(output, '<S>') - 4) || substring(output, strpos(output, '<M>') + 3) || substring(output, strpos(output, '<S>') + 3, strpos(output, '<M>') - strpos(output, '<S>') - 3)
    ELSE substring(output, strpos(output, '<P>') + 3, strpos(output, '<M>') - strpos(output, '<P>') - 3) || substring(output, strpos(output, '<M>') + 3) || substring(output, 4, strpos(output, '<P>') - 4) END) AS restored_sha256
FROM o"""
