"""Operator 7: near-duplicate embeddings by cross-polytope hashing.

Equal vectors are one representative with a multiplicity. A representative is rotated by
three rounds of random signs and a fast Hadamard transform; its cross-polytope hash is the
signed axis of the largest coordinate, ``width`` axes from different rotations make a bucket
key, and each of ``tables`` tables has its own rotations. A vector lives in its own bucket and
visits the ``probes`` buckets that changing one axis to a runner-up reaches at the least loss.

A bucket is compared by matrix products in double precision, vectors at home with each other
and with visitors. A pair that meets in several buckets is counted in the first one only
(decided from the keys that travel with the vectors), so a task returns link counts per vector
and a spanning forest, never all pairs. Buckets above ``block`` vectors are dealt out as pairs
of blocks over many tasks; every pair of blocks is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut


def hadamard(x: np.ndarray) -> np.ndarray:
    """Unnormalised fast Walsh-Hadamard transform of the rows; a power of two columns."""
    x = x.copy()
    h, d = 1, x.shape[1]
    while h < d:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(len(x), d)
        h *= 2
    return x


def signs(seed: int, dim: int) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (3, dim))


def keys(x: np.ndarray, table: int, width: int, probes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(home, visits) bucket keys of unit rows in one table; visits has ``probes`` columns."""
    dim = 1 << max(1, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    axes, losses = [], []
    for j in range(width):
        y = x
        for s in signs(seed + 1009 * table + j, dim):
            y = hadamard(y * s) / np.sqrt(dim)
        both = np.concatenate((y, -y), 1)
        top = np.argsort(-both, axis=1, kind="stable")[:, :probes + 1]
        value = np.take_along_axis(both, top, 1)
        axes.append(top)
        losses.append((value[:, :1] - value[:, 1:]) ** 2)
    base = np.int64(2 * dim)
    power = base ** np.arange(width, dtype=np.int64)
    home = sum(a[:, 0] * p for a, p in zip(axes, power))
    moves = np.concatenate([home[:, None] + (a[:, 1:] - a[:, :1]) * p for a, p in zip(axes, power)], 1)
    best = np.argsort(np.concatenate(losses, 1), axis=1, kind="stable")[:, :probes]
    return home, np.take_along_axis(moves, best, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaling by the largest part avoids overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def _coded(reps: DataFrame, tables: int, width: int, probes: int, seed: int) -> DataFrame:
    """``reps`` (rep, times, vec, dim) with codes: home and visited bucket keys of all tables."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            dims = whole.column(3).to_numpy()
            alike = [whole.take(pa.array(np.flatnonzero(dims == d))) for d in np.unique(dims)]
            for b in (w.slice(at, 1024) for w in alike for at in range(0, w.num_rows, 1024)):
                x = _unit(_matrix(b.column(2)))
                if (2 << max(1, x.shape[1] - 1).bit_length()) ** width >= 1 << 31:
                    raise ValueError("bucket keys exceed 32 bits: choose a smaller width")
                per = [keys(x, t, width, probes, seed) for t in range(tables)]
                codes = np.concatenate([np.concatenate((h[:, None], v), 1) for h, v in per], 1).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, codes.shape[1], np.int32)), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns, lists], ["rep", "times", "vec", "dim", "codes"])
    return reps.mapInArrow(run, f"rep long, times long, vec {reps.schema['vec'].dataType.simpleString()}, dim int, codes array<int>")


def _forest(u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs."""
    parent: dict[int, int] = {}

    def top(a: int) -> int:
        while parent.setdefault(a, a) != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    out = []
    for a, b in zip(u.tolist(), v.tolist()):
        ra, rb = top(a), top(b)
        if ra != rb:
            parent[ra] = rb
            out.append((a, b))
    return out


def _compare(g: dict[str, np.ndarray], tab: int, left: int, right: int, probes: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (a, b) of the linked pairs that this bucket's block pair has to report."""
    m = probes + 1
    home, rep, blk, codes = g["home"], g["rep"], g["blk"], g["codes"].reshape(len(g["rep"]), -1, m)
    ia, ib = np.flatnonzero(home & (blk == left)), np.flatnonzero(blk == right)
    if left != right:  # also visitors of the left block with vectors at home in the right one
        sides = [(ia, ib), (np.flatnonzero(home & (blk == right)), np.flatnonzero(~home & (blk == left)))]
    else:
        sides = [(ia, ib)]
    found = [[], []]
    for a, b in sides:
        for s in range(0, len(a), 512):
            p, q = np.nonzero(g["vec"][a[s:s + 512]] @ g["vec"][b].T >= least)
            p, q = a[s + p], b[q]
            ok = (rep[p] != rep[q]) & (~home[q] | (rep[p] < rep[q]) | (left != right))
            p, q = p[ok], q[ok]
            # met before: in an earlier table, or in this one by the visit of the smaller id
            same = codes[p, :, 0] == codes[q, :, 0]
            visit = (codes[p, :, :1] == codes[q, :, 1:]).any(2) | (codes[q, :, :1] == codes[p, :, 1:]).any(2)
            early = (same | visit)[:, :tab].any(1)
            back = (codes[q, tab, :1] == codes[p, tab, 1:]).any(1)  # p visits the home of q too
            ok = ~early & (home[q] | ~back | (rep[q] < rep[p]))
            found[0].append(p[ok])
            found[1].append(q[ok])
    return (np.concatenate(found[0]), np.concatenate(found[1])) if found[0] else (np.empty(0, int), np.empty(0, int))


def _floats(vectors: DataFrame, col: str):
    kind = vectors.schema[col].dataType.simpleString()
    return vectors[col] if kind in ("array<float>", "array<double>") else vectors[col].cast("array<double>")


def near_duplicates(vectors: DataFrame, least: float = 0.9, tables: int = 8, width: int = 2, probes: int = 4, block: int = 1024, seed: int = 7,
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Links have a cosine of at least ``least`` in double precision, computed on unit vectors.
    Vectors that are null, empty, zero or hold null or non-finite parts link with nothing;
    vectors of different lengths do not link. Rows with equal vectors are linked copies; rows
    with a null id are returned with null component and kept and link with nothing. Other
    columns are not read.
    """
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), _floats(vectors, vec_col).alias("vec"))
    good = (F.col("vec_id").isNotNull() & (F.size("vec") > 0)
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    v = v.withColumn("good", F.coalesce(good, F.lit(False)))
    groups = cut(v.where("good").groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times")).select("rep", "times", "vec", F.size("vec").alias("dim")))

    coded = cut(_coded(groups.select("rep", "times", "vec", "dim"), tables, width, probes, seed))
    m = probes + 1
    narrow = (coded.select("rep", "dim", F.posexplode("codes").alias("slot", "key"))
              .select("rep", "dim", F.floor(F.col("slot") / m).cast("int").alias("tab"), "key", (F.col("slot") % m == 0).alias("home")))
    sizes = (narrow.groupBy("dim", "tab", "key").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("long")).alias("at_home"))
             .where("n > 1 and at_home > 0").select("dim", "tab", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    dealt = (narrow.join(sizes, ["dim", "tab", "key"])
             .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("blk", "other")).withColumn("hi", F.greatest("blk", "other")))
    # the length is a part of the key: vectors of all lengths go through one plan
    order = ["dim", "tab", "key", "lo", "hi"]
    dealt = dealt.join(coded.drop("dim"), "rep").select(*order, "blk", "rep", "times", "home", "vec", "codes").repartition(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Links of whole block pairs, length by length."""
            t = pa.Table.from_batches(parts).combine_chunks()
            dims = t.column("dim").to_numpy()
            edge = (np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist()
            for s, e in zip([0, *edge], [*edge, t.num_rows]):
                if e > s and (out := alike(t.slice(s, e - s))) is not None:
                    yield out

        def alike(t: pa.Table) -> pa.RecordBatch | None:
            """Link counts (v null) and forest edges (n null) of block pairs of one length."""
            num = {c: t.column(c).to_numpy() for c in (*order, "blk", "rep", "times", "home")}
            num["vec"] = _unit(_matrix(t.column("vec").combine_chunks()))
            num["codes"] = t.column("codes").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            group = np.stack([num[c] for c in order], 1)
            edge = np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1
            us, vs = [], []
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), t.num_rows]):
                if e - s > 1:
                    g = {c: x[s:e] for c, x in num.items()}
                    a, b = _compare(g, int(num["tab"][s]), int(num["lo"][s]), int(num["hi"][s]), probes, least)
                    us.append(a + s)
                    vs.append(b + s)
            if not us or not sum(map(len, us)):
                return None
            a, b = np.concatenate(us), np.concatenate(vs)
            rep, times = num["rep"], num["times"]
            node, slot = np.unique(np.concatenate((rep[a], rep[b])), return_inverse=True)
            n = np.bincount(slot, np.concatenate((times[b], times[a]))).astype(np.int64)
            tree = _forest(rep[a], rep[b])
            return pa.RecordBatch.from_arrays([pa.array([*node.tolist(), *(x for x, _ in tree)], pa.int64()),
                                               pa.array([None] * len(node) + [y for _, y in tree], pa.int64()),
                                               pa.array([*n.tolist(), *([None] * len(tree))], pa.int64())], ["u", "v", "n"])
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy() for c in order]
            tail = tuple(int(c[-1]) for c in cols)
            start = b.num_rows - 1
            while start > 0 and all(int(c[start - 1]) == x for c, x in zip(cols, tail)):
                start -= 1
            if start > 0 or tail != last:
                head = b.slice(0, start)
                if held or start:
                    yield from done([*held, head] if start else held)
                held = [b.slice(start)]
            else:
                held.append(b)
            last = tail
        if held:
            yield from done(held)
    found = cut(dealt.mapInArrow(run, "u long, v long, n long"))
    links = found.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    label = components(found.where("v is not null").select("u", "v"))
    home = (groups.join(links, "rep", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left")
            .select("vec", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n"), F.coalesce("root", "rep").alias("root")))
    linked = v.where("good").join(home, "vec").select("vec_id", "n", "root")
    alone = v.where("not good").select("vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("root"))
    return linked.unionByName(alone).select("vec_id", F.col("n").alias("n_links"), F.col("root").alias("component_id"), (F.col("vec_id") == F.col("root")).alias("kept"))
