"""Operator 9: substring dedup by Rabin-Karp hashes of every fixed-length word window.

1. Tasks gather their documents into chunks of a bounded number of windows and compute the
   rolling hash of every window. A chunk sends each of its distinct hashes once, packed by
   hash bucket with the window's position, marked if the chunk itself holds it several times.
   A window that occurs in a third of all documents adds one entry per chunk, so buckets stay
   even however frequent a window is.
2. Every bucket counts its hashes over all chunks and answers each chunk with the positions
   of its repeated windows.
3. Every chunk merges the answers into maximal intervals of covered words per document.

Hashes are 64 bits of a polynomial over 64-bit word hashes: among n windows, a window is
wrongly taken for a repeated one with a probability below n / 2^64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, mix, word_hashes, words_of

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 4096)
            cls.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, _BASE))))
            cls.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, _UNBASE))))
        return cls.up[:n], cls.down[:n]


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rolling hash of each window of ``width`` words (arithmetic modulo 2^64): prefix sums of
    word hash times a power of the base, then the window's difference brought back to power 0."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _Powers.of(len(hashes))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * up, dtype=np.uint64)))
    return mix((sums[width:] - sums[:n]) * down[:n])


def covered(repeated: np.ndarray, n_words: int, width: int) -> np.ndarray:
    """Words covered by a repeated window."""
    step = np.zeros(n_words + 1, np.int32)
    at = np.flatnonzero(repeated)
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    return np.cumsum(step[:-1]) > 0


def intervals(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of covered words as (first, one past the last)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _pack_positions(at: np.ndarray) -> bytes:
    """Sorted positions as differences in two 16-bit planes; the upper one is mostly zero."""
    d = np.diff(at, prepend=0).astype(np.uint32)
    return (d & 0xFFFF).astype("<u2").tobytes() + (d >> 16).astype("<u2").tobytes()


def _unpack_positions(packed: bytes) -> np.ndarray:
    low, high = np.frombuffer(packed, "<u2").reshape(2, -1).astype(np.int64)
    return np.cumsum(low + (high << 16))


_ENTRIES = "chunk long, bucket int, hashes binary, places binary, many binary, docs binary"


def _chunks(src: DataFrame, width: int, chunk_windows: int, n_buckets: int) -> DataFrame:
    """Rows (chunk, bucket, hashes, places, many) for the buckets and one row per chunk with
    bucket -1: places of windows repeated inside the chunk, docs as (k1, k2, windows) triples."""
    shift = np.uint64(64 - n_buckets.bit_length() + 1)

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n_chunk = TaskContext.get().partitionId() << 32, 0
        keys: list[tuple[int, int, int]] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, parts, held, n_chunk
            h = np.concatenate(parts)
            uniq, first, slot, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            bucket = (uniq >> shift).astype(np.int64)
            edge = np.searchsorted(bucket, np.arange(n_buckets + 1))
            rows = [[], [], [], []]
            for b in np.flatnonzero(np.diff(edge)).tolist():
                part = slice(edge[b], edge[b + 1])
                order = np.argsort(first[part])
                rows[0].append(b)
                # the bucket holds the upper 8 bits at least, 7 bytes of the hash are left
                rows[1].append(uniq[part][order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes())
                rows[2].append(_pack_positions(first[part][order]))
                rows[3].append(np.packbits(count[part][order] > 1).tobytes())
            rows[0].append(-1)
            rows[1].append(None)
            rows[2].append(_pack_positions(np.flatnonzero(count[slot] > 1)))
            rows[3].append(None)
            n = len(rows[0])
            out = pa.RecordBatch.from_arrays(
                [pa.array([task + n_chunk] * n, pa.int64()), pa.array(rows[0], pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:]),
                 pa.array([None] * (n - 1) + [np.array(keys, "<i8").tobytes()], pa.binary())],
                ["chunk", "bucket", "hashes", "places", "many", "docs"])
            keys, parts, held, n_chunk = [], [], 0, n_chunk + 1
            return out

        for b in batches:
            for k1, k2, text in zip(*(c.to_pylist() for c in b.columns)):
                h = window_hashes(word_hashes(words_of(text)), width)
                if len(h):
                    keys.append((k1, k2, len(h)))
                    parts.append(h)
                    held += len(h)
                if held >= chunk_windows:
                    yield flush()
        if parts:
            yield flush()
    return src.mapInArrow(chunk, _ENTRIES)


def _count_bucket(t: pa.Table) -> pa.Table:
    """Answers of one bucket: (chunk, places of windows that another chunk holds too). A
    chunk's own row passes through."""
    if t.column("bucket")[0].as_py() < 0:
        return t.select(["chunk", "places", "docs"])
    hashes = [np.frombuffer(x, np.uint8).reshape(-1, 7) for x in t.column("hashes").to_pylist()]
    sizes = np.array([len(h) for h in hashes])
    h = np.zeros((int(sizes.sum()), 8), np.uint8)
    h[:, :7] = np.concatenate(hashes)
    h = h.view("<u8").ravel()
    order = np.argsort(h, kind="stable")
    same = np.zeros(len(h), bool)
    eq = h[order][1:] == h[order][:-1]
    same[order[1:][eq]] = True
    same[order[:-1][eq]] = True
    chunk, places, at = [], [], 0
    for c, p, m, n in zip(t.column("chunk").to_pylist(), t.column("places").to_pylist(), t.column("many").to_pylist(), sizes.tolist()):
        hit = same[at:at + n] & ~np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool)
        at += n
        if hit.any():
            chunk.append(c)
            places.append(_pack_positions(_unpack_positions(p)[hit]))
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "places": pa.array(places, pa.binary()), "docs": pa.nulls(len(chunk), pa.binary())})


def repeated_spans(docs: DataFrame, width: int = 35, chunk_windows: int = 400_000, text_col: str = "text") -> DataFrame:
    """(k1, k2, spans binary): the maximal intervals of words to remove as pairs of 32-bit
    (first, one past the last), for the documents that have any. ``docs`` has k1 and k2 from
    ``keyed``; rows with equal keys have equal texts and so equal spans.

    Two occurrences anywhere count, also in one document and also overlapping. Null and empty
    texts and texts shorter than a window have no windows.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(256, 1 << (8 * partitions - 1).bit_length())
    entries = _chunks(docs.select("k1", "k2", text_col), width, chunk_windows, n_buckets)
    answers = (entries.withColumn("own", F.when(F.col("bucket") < 0, F.col("chunk")).otherwise(F.lit(-1)))
               .groupBy("bucket", "own").applyInArrow(lambda t: _count_bucket(t), "chunk long, places binary, docs binary"))

    def gather(t: pa.Table) -> pa.Table:
        """Intervals of the documents of one chunk."""
        docs = np.frombuffer(next(d for d in t.column("docs").to_pylist() if d is not None), "<i8").reshape(-1, 3)
        ends = np.cumsum(docs[:, 2])
        places = np.sort(np.concatenate([_unpack_positions(p) for p in t.column("places").to_pylist()]))
        owner = np.searchsorted(ends, places, side="right")
        k1, k2, spans = [], [], []
        for d in np.unique(owner).tolist():
            n = int(docs[d, 2])
            hit = np.zeros(n, bool)
            hit[places[owner == d] - (ends[d] - n)] = True
            k1.append(int(docs[d, 0]))
            k2.append(int(docs[d, 1]))
            spans.append(np.array(intervals(covered(hit, n + width - 1, width)), "<i4").tobytes())
        return pa.table({"k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "spans": pa.array(spans, pa.binary())})

    found = answers.groupBy("chunk").applyInArrow(gather, "k1 long, k2 long, spans binary")
    return found.groupBy("k1", "k2").agg(F.min("spans").alias("spans"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add k1, k2, the key of a row's text: its id (null: the smallest long) and text hash."""
    return docs.withColumns({"k1": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), "k2": F.xxhash64(text_col)})


def cut_words(text: str | None, spans: bytes | None) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one blank, UTF-8) of a text."""
    words = words_of(text)
    if not spans:
        return len(words), 0, b" ".join(words)
    kept, at, gone = [], 0, 0
    for first, end in np.frombuffer(spans, "<i4").reshape(-1, 2).tolist():
        kept.extend(words[at:first])
        gone += end - first
        at = end
    kept.extend(words[at:])
    return len(words), gone, b" ".join(kept)


def with_spans(docs: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``spans`` (null where nothing is to be removed)."""
    d = keyed(docs.select(docs[id_col].alias("__id"), docs[text_col].alias("__text")), "__id", "__text")
    spans = repeated_spans(d, width, text_col="__text").alias("s")
    own = docs.select(*[docs[c] for c in docs.columns],
                      F.coalesce(docs[id_col].cast("long"), F.lit(-(1 << 63))).alias("__k1"), F.xxhash64(docs[text_col]).alias("__k2"))
    return own.join(spans, (F.col("__k1") == F.col("s.k1")) & (F.col("__k2") == F.col("s.k2")), "left").select(*[own[c] for c in docs.columns], F.col("s.spans").alias("spans"))


def digests(docs: DataFrame, width: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document, judged on the input."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [cut_words(t, s) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return map_batches(with_spans(d, width), batch, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, width: int = 35, text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages removed from the text: the kept words joined by one
    blank where something is removed, otherwise the text as it is (null stays null)."""
    cols = docs.columns
    at = cols.index(text_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t if s is None else cut_words(t, s)[2].decode("utf-8", "surrogatepass")
                 for t, s in zip(b.column(at).to_pylist(), b.column(len(cols)).to_pylist())]
        out = list(b.columns[:-1])
        out[at] = pa.array(texts, b.column(at).type)
        return pa.RecordBatch.from_arrays(out, cols)
    return with_spans(docs, width, text_col=text_col).mapInArrow(lambda bs: (batch(b) for b in bs if b.num_rows), docs.schema)
