"""Small helpers shared by the operators: table access, words, word hashes, components.

Word rule of all contracts: maximal runs of characters other than blank and U+0009..U+000D.
On UTF-8 bytes these six characters are single bytes that never occur inside a longer
sequence, so ``bytes.split`` on them gives the words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsweave.session import checkpoint_dir

_SPACES = bytes.maketrans(b"\x09\x0a\x0b\x0c\x0d", b"     ")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None, table: bytes | None = None) -> list[bytes]:
    """The words of a text as UTF-8 bytes, mapped by ``table`` if given, which must leave white
    space as it is; none for null."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.translate(_SPACES) if table is None else data.translate(_SPACES).translate(table)).split()


class BoundedCache(dict):
    """A memo that is emptied when it holds ``limit`` entries; it never changes a result."""

    def __init__(self, fn: Callable, limit: int = 400_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        v = self[key] = self.fn(key)
        return v


#: Beyond the common words a longer memo saves no time, but takes 50 MB a worker.
_WORD_HASH = BoundedCache(xxhash.xxh3_64_intdigest, 100_000)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word (uint64)."""
    return np.fromiter(map(_WORD_HASH.__getitem__, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(h: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every input bit over all 64 output bits."""
    h = (h ^ (h >> _S30)) * _M1
    h = (h ^ (h >> _S27)) * _M2
    return h ^ (h >> _S31)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one record batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None:
                yield out
    return df.mapInArrow(run, schema)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def components(edges: DataFrame, guard: int = 200) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v long): root is the smallest node of its
    connected component.

    Alternating large-star and small-star rounds on the edges; every round is checkpointed,
    only the count and a checksum reach the driver. The hub of a large component occurs as a
    join key once per neighbour, but the joined side is the table of minima with one row per
    key, so the adaptive skew join can split it. Raises if ``guard`` rounds do not converge.
    """
    e = (edges.where(F.col("u") != F.col("v"))
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = cut(e)
    last = None
    for _ in range(guard):
        h = F.xxhash64("u", "v")
        r = e.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x")).first()
        if (r["n"], r["x"]) == last or r["n"] == 0:
            break
        last = (r["n"], r["x"])
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        e = (large.join(low2, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("p")).select("p.*")
            .where("u != v").distinct())
        e = cut(e)
    else:
        raise RuntimeError(f"components did not converge in {guard} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
