"""Operator 11: vector code compression by dual-tree Lloyd rounds over integer vectors.

Vectors become integers, are cut into equal parts, and every part position gets a codebook. The
rows of a record batch form a block; for each part position of a block a tree over its parts is
built once (halved at the median of the widest side) with the box, the sum and the size of every
node, and kept in a checkpoint. Each round a second tree is built over the few entries of a
codebook, and both are descended together: a pair (node of parts, node of entries) is dropped
when its smallest possible distance exceeds the largest possible distance of another pair of
that node. A node of parts with one entry left is assigned as a whole by its cached sum; parts
in leaves that stay uncertain are compared with the remaining entries.

All bounds, distances and sums are integers, so the result does not depend on blocks or trees.
Per round only sums and counts per entry are shuffled and reach the driver: parts * entries *
width numbers, whatever the table holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

SCALE = 4096


class Tree(NamedTuple):
    """A complete binary tree over rows; level l has nodes 2**l - 1 .. 2**(l+1) - 2."""
    order: np.ndarray   # rows in tree order
    points: np.ndarray  # rows themselves, in that order
    start: np.ndarray   # first and last + 1 place of each node
    stop: np.ndarray
    low: np.ndarray     # box of each node
    high: np.ndarray
    total: np.ndarray   # sum of each node
    depth: int


def build(points: np.ndarray, leaf: int) -> Tree:
    """Tree over int64 rows (at least one) with leaves of ``leaf`` to 2 * leaf - 1 rows, or one
    leaf. Equal rows are allowed; a node is never empty."""
    n = len(points)
    depth = max(0, (n // leaf).bit_length() - 1)
    order, bounds, nodes = np.arange(n), np.array([0, n]), []
    for level in range(depth + 1):
        at = points[order]
        low, high = np.minimum.reduceat(at, bounds[:-1]), np.maximum.reduceat(at, bounds[:-1])
        nodes.append((bounds[:-1], bounds[1:], low, high))
        if level < depth:
            node = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            side = (high - low).argmax(axis=1)
            order = order[np.lexsort((at[np.arange(n), side[node]], node))]
            bounds = np.sort(np.concatenate((bounds, (bounds[:-1] + bounds[1:]) // 2)))
    at = points[order]
    start, stop, low, high = (np.concatenate(x) for x in zip(*nodes))
    total = np.concatenate([np.add.reduceat(at, s) for s, _, _, _ in nodes])
    return Tree(order, at, start, stop, low, high, total, depth)


def _prune(tree: Tree, p: np.ndarray, e: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (node, box e), ordered by node, without those whose smallest distance exceeds the
    largest one of another pair of the node; and which of them are the only one of their node."""
    gap = np.maximum(np.maximum(low[e] - tree.high[p], tree.low[p] - high[e]), 0)
    far = np.maximum(tree.high[p] - low[e], high[e] - tree.low[p])
    fresh = np.r_[True, p[1:] != p[:-1]]
    group = np.cumsum(fresh) - 1
    keep = (gap * gap).sum(axis=1) <= np.minimum.reduceat((far * far).sum(axis=1), np.flatnonzero(fresh))[group]
    return p[keep], e[keep], np.bincount(group[keep])[group[keep]] == 1


def descend(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(whole node, its entry) and (leaf, possible entry) of all parts of ``tree``; every part is
    below exactly one whole node or one uncertain leaf. Ties stay uncertain."""
    other = build(entries, 1)
    p, e, whole = np.zeros(1, np.int64), np.zeros(1, np.int64), []
    last_p, last_e = 2 ** tree.depth - 1, 2 ** other.depth - 1
    for _ in range(max(tree.depth, other.depth) + 1):
        if not len(p):
            break
        p, e, alone = _prune(tree, p, e, other.low, other.high)
        alone &= other.stop[e] - other.start[e] == 1
        whole.append((p[alone], other.order[other.start[e[alone]]]))
        p, e = p[~alone], e[~alone]
        # pairs of children; a leaf stays, so that in the end all pairs are pairs of leaves
        pairs = [(np.where(p >= last_p, p, 2 * p + a), np.where(e >= last_e, e, 2 * e + b), ((a == 1) | (p < last_p)) & ((b == 1) | (e < last_e)))
                 for a in (1, 2) for b in (1, 2)]
        p, e = np.concatenate([x[ok] for x, _, ok in pairs]), np.concatenate([x[ok] for _, x, ok in pairs])
        by = np.argsort(p, kind="stable")
        p, e = p[by], e[by]
    # an entry leaf holds one or two entries: the last bounds are those of single entries
    size = other.stop[e] - other.start[e]
    p, e = np.repeat(p, size), other.order[np.repeat(other.start[e], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
    if len(p):
        p, e, alone = _prune(tree, p, e, entries, entries)
        whole.append((p[alone], e[alone]))
        p, e = p[~alone], e[~alone]
    return (*map(np.concatenate, zip(*whole)), p, e)


def _places(tree: Tree, nodes: np.ndarray) -> np.ndarray:
    """The places below ``nodes``."""
    size = tree.stop[nodes] - tree.start[nodes]
    return np.repeat(tree.start[nodes] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())


def assign(tree: Tree, entries: np.ndarray, labels: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]:
    """(sums, counts) per entry; with ``labels`` also the entry and the squared distance of every
    part, in the order of the rows the tree was built from. Ties go to the lower entry."""
    node, entry, leaf, possible = descend(tree, entries)
    sums, counts = np.zeros_like(entries), np.zeros(len(entries), np.int64)
    np.add.at(sums, entry, tree.total[node])
    np.add.at(counts, entry, tree.stop[node] - tree.start[node])
    best = np.full(len(tree.points), np.iinfo(np.int64).max)
    mine = np.full(len(tree.points), -1)
    for k in range(len(entries)):  # ascending, and only a smaller distance replaces
        at = _places(tree, leaf[possible == k])
        rest = tree.points[at] - entries[k]
        d = (rest * rest).sum(axis=1)
        less = d < best[at]
        best[at[less]], mine[at[less]] = d[less], k
    seen = np.flatnonzero(mine >= 0)
    np.add.at(sums, mine[seen], tree.points[seen])
    counts += np.bincount(mine[seen], minlength=len(entries))
    if not labels:
        return sums, counts, None, None
    at = _places(tree, node)
    mine[at] = np.repeat(entry, tree.stop[node] - tree.start[node])
    rest = tree.points - entries[mine]
    out, error = np.empty_like(mine), np.empty_like(best)
    out[tree.order], error[tree.order] = mine, (rest * rest).sum(axis=1)
    return sums, counts, out, error


def integers(vectors: pa.Array, dim: int) -> np.ndarray:
    """floor(4096 * x) of a list column as int64 (rows, dim); short vectors end in zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    bound = limit(dim)
    q = np.floor(np.clip(flat, -bound / SCALE, bound / SCALE) * SCALE).astype(np.int64)
    if len(lengths) and (lengths == dim).all():
        return q.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(q)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = q
    return out


def limit(dim: int) -> int:
    """Largest integer component: with it any error of ``dim`` components fits a long."""
    return 1 << ((62 - max(dim - 1, 0).bit_length()) // 2 - 1)


_ARRAYS = ("order", "points", "start", "stop", "low", "high", "total")


def _pack(tree: Tree) -> list[bytes]:
    """The arrays of a tree as bytes, coordinates as 16-bit integers where these hold them."""
    small = np.int16 if tree.low.min() >= -1 << 15 and tree.high.max() < 1 << 15 else np.int32
    kinds = {"order": np.int32, "start": np.int32, "stop": np.int32, "points": small, "low": small, "high": small, "total": np.int64}
    return [np.dtype(small).char.encode()] + [getattr(tree, a).astype(kinds[a]).tobytes() for a in _ARRAYS]


def _unpack(found: list[bytes], width: int) -> Tree:
    small = np.dtype(found[0].decode())
    kinds = {"order": np.int32, "start": np.int32, "stop": np.int32, "points": small, "low": small, "high": small, "total": np.int64}
    got = {a: np.frombuffer(x, kinds[a]).astype(np.int64) for a, x in zip(_ARRAYS, found[1:])}
    for a, rows in (("points", "order"), ("low", "start"), ("high", "start"), ("total", "start")):
        got[a] = got[a].reshape(len(got[rows]), width)
    return Tree(**got, depth=(len(got["start"]) + 1).bit_length() - 2)


def _blocks(rows: DataFrame, dim: int, parts: int, leaf: int, block_rows: int, label: str) -> DataFrame:
    """One row per block: ids, labels and the packed trees of all part positions."""
    width = dim // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(s, block_rows) for s in range(0, whole.num_rows, block_rows)):
                q = integers(b.column(1), dim)
                trees = [_pack(build(q[:, p * width:(p + 1) * width], leaf)) for p in range(parts)]
                offsets = pa.array([0, b.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.concat_arrays([b.column(0)])), pa.ListArray.from_arrays(offsets, pa.concat_arrays([b.column(2)])),
                                                  pa.array([trees], pa.list_(pa.list_(pa.binary())))], ["ids", "labels", "trees"])
    return rows.mapInArrow(run, f"ids array<long>, labels array<{label}>, trees array<array<binary>>")


def _means(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one Lloyd round; an entry without parts stays."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for b in batches:
            for trees in b.column("trees"):
                for p, tree in enumerate(trees.as_py()):
                    s, c, _, _ = assign(_unpack(tree, width), books[p], labels=False)
                    sums[p] += s
                    counts[p] += c
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))],
                                         ["part", "entry", "n", "sums"])
    found = blocks.select("trees").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    found = (found.select("part", "entry", "n", F.posexplode("sums").alias("i", "s")).groupBy("part", "entry", "i")
             .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())  # parts * entries * width rows
    out = books.copy()
    for r in found:
        out[r["part"], r["entry"], r["i"]] = r["s"] // r["n"]
    return out


def _codes(blocks: DataFrame, books: np.ndarray, label: str) -> DataFrame:
    """(vec_id, label, code, error) per row by final codebooks."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, trees in enumerate(b.column("trees")):
                codes, error = [], 0
                for p, tree in enumerate(trees.as_py()):
                    _, _, mine, d = assign(_unpack(tree, width), books[p], labels=True)
                    codes.append(mine.astype(np.uint8))
                    error = error + d
                code = [x.tobytes().hex() for x in np.stack(codes, axis=1)]
                yield pa.RecordBatch.from_arrays([b.column("ids")[i].values, b.column("labels")[i].values, pa.array(code), pa.array(error)], ["vec_id", "label", "code", "error"])
    return blocks.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


#: Above so many labels their sums are not broadcast; rows of a label are dealt over SALTS keys.
BROADCAST_LABELS, SALTS = 200_000, 32


def _with_label_error(rows: DataFrame, broadcast_labels: int) -> DataFrame:
    """Add the error summed over rows of equal label (nulls together)."""
    longest = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = cut(rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(28,0)")).alias("s")).select("label", F.least("s", longest).cast("long").alias("label_error")))
    if sums.count() <= broadcast_labels:
        right = F.broadcast(sums.withColumnRenamed("label", "of"))
        return rows.join(right, rows["label"].eqNullSafe(right["of"]), "left").drop("of")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int"))
    right = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    return salted.join(right, salted["label"].eqNullSafe(right["of"]) & (salted["salt"] == right["of_salt"]), "left").drop("of", "salt", "of_salt")


def compress(docs: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, leaf: int = 32, block_rows: int = 4096, broadcast_labels: int = BROADCAST_LABELS,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per kept row of ``docs``.

    Rows whose vector is null or holds null or non-finite components are dropped. Codebooks start
    as the parts of the ``entries`` smallest kept ids (null ids last, equal ids by their vector);
    with fewer rows there are fewer entries. Vectors shorter than the longest, or whose length is
    no multiple of ``parts``, count as continued with zeros. Components are limited to +-
    ``limit(dim) / 4096`` (32,768 for 64 components), beyond which no long holds the error; a
    label's sum that no long holds becomes the largest one. Repeated rows are coded each; an empty
    table stays empty; other columns are not read.
    """
    label = docs.select(docs[label_col]).schema[0].dataType.simpleString()
    src = docs.select(docs[id_col].cast("long").alias("vec_id"), docs[vec_col].alias("v"), docs[label_col].alias("label"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    src = src.where(F.col("v").isNotNull() & fine)
    dim = src.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0
    dim = max(-(-dim // parts), 1) * parts
    first = src.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return src.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = integers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), dim)
    books = np.ascontiguousarray(books.reshape(len(first), parts, dim // parts).transpose(1, 0, 2))
    blocks = cut(_blocks(src, dim, parts, leaf, block_rows, label))
    for _ in range(rounds):
        books = _means(blocks, books)
    coded = cut(_codes(blocks, books, label))
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return _with_label_error(coded, broadcast_labels).select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The query's rows in SQL, every round a pair of common table expressions."""
    nearest = ("SELECT x.vec_id, x.part, b.entry, sum((x.q - b.q) * (x.q - b.q)) AS d FROM long x JOIN book{k} b ON x.part = b.part AND x.i = b.i "
               "GROUP BY x.vec_id, x.part, b.entry QUALIFY row_number() OVER (PARTITION BY x.vec_id, x.part ORDER BY d, b.entry) = 1")
    steps = []
    for k in range(rounds):
        steps.append(f"near{k} AS MATERIALIZED ({nearest.format(k=k)})")
        steps.append(f"book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.q)::BIGINT AS q FROM book{k} b LEFT JOIN "
                     f"(SELECT x.part, a.entry, x.i, sum(x.q)::BIGINT AS s, count(*) AS n FROM long x JOIN near{k} a ON x.vec_id = a.vec_id AND x.part = a.part GROUP BY x.part, a.entry, x.i) m "
                     f"ON b.part = m.part AND b.entry = m.entry AND b.i = m.i)")
    rest = ",\n".join(steps)
    return f"""
WITH kept AS (SELECT vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS MATERIALIZED (SELECT vec_id, j // (len(v) // {parts}) AS part, j % (len(v) // {parts}) AS i, floor(4096 * v[j + 1]::DOUBLE)::BIGINT AS q
  FROM (SELECT *, unnest(range(len(v)))::BIGINT AS j FROM kept)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {entries}),
book0 AS MATERIALIZED (SELECT part, entry, i, q FROM long JOIN first USING (vec_id)),
{rest},
final AS MATERIALIZED ({nearest.format(k=rounds)}),
sha AS (SELECT sha256(string_agg(q::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM book{rounds}),
coded AS (SELECT vec_id, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM final GROUP BY vec_id)
SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id CROSS JOIN sha"""
