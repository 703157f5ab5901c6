"""Operator 3: n-gram Jaccard self-join with a token-group matrix.

A document is the set of its distinct k-word shingles (64-bit hashes). Equal sets are one
representative from the start, so a group of copies costs one row. Two sets link when
100 * |A and B| >= percent * |A or B|; then each shares a shingle among the other's first
``n - ceil(percent*n/100) + 1`` in any fixed order (prefix), which bounds the search exactly.
The order puts rare shingles first: frequencies come from a count sketch of fixed size over
all documents; it only steers cost, never the result.

1. Prefix shingles of all representatives; only those that sets of similar size share go on.
2. Partition similar documents into groups: representatives that share a min-hash (of four)
   are compared with a few leaders of their class, and what the closest one may link with joins
   it if their full sets do. Sets whose rarest shared shingle comes first in their order lead:
   they are closest to what the class has in common. Here and below, parities of a set's hashes
   (about a bit or two a shingle) bound how many shingles two sets do not share, which leaves few
   texts to be read that do not link.
   A class of m near copies takes m times ``leaders`` comparisons, not m squared.
3. Every set meets the largest group that shares a shingle of its prefix, one group a set, so
   that near copies left outside a large group do not all meet each other in step 4.
4. Token-group matrix: one row per (shingle, group), the union of the members' prefixes, with
   the shingle's first place in a member and the sizes of the members that hold it. A
   document (query) meets foreign groups through it. If a shingle is the first that two sets
   share, then what lies before it in either is not shared: its places bound the overlap, and
   only groups that can reach the threshold through some shingle are opened.

In steps 3 and 4, the members of opened groups (in parts of about ``part_shingles`` shingles) and
the queries that open them meet in one task. An index of the part bounds a query with all its
members at once, by the places and the number of the shingles that their prefixes share, then by
the parities; no row is made for a pair. What remains is verified in the same way on the full
sets, which are built from the texts for these documents only. The members of a group are
connected, so that one link of a query with a part tells as much as all of them.

Shingles and sets are compared by 64-bit hashes: among s distinct shingles some two collide
with a probability of about s * s / 2**65, and a collision changes a result only where it meets
the threshold.

Links inside a group that is already connected are not looked for: they cannot change which
documents are connected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, mix, word_hashes, words_of

#: Count sketch: rows and slots per row (fixed, about 1 MB on the driver and in a broadcast).
SKETCH_ROWS, SKETCH_SLOTS = 2, 1 << 16
_A = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3))
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Rows of a batch that a task looks at, and makes sets of, at a time.
_ROWS = 256


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text, A-Z lower-cased; with
    fewer than k words the whole sequence is one shingle; none without words."""
    words = words_of(text, _LOWER)
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    n = min(k, len(h))
    acc = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        acc = mix(acc * _A + h[i:len(h) - n + 1 + i])
    return np.unique(acc)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, _ROWS):
            yield b.slice(k, _ROWS)


def _slots(tokens: np.ndarray) -> Iterator[np.ndarray]:
    for r in range(SKETCH_ROWS):
        yield (mix(tokens ^ _SEEDS[r]) >> np.uint64(48)).astype(np.int64) + r * SKETCH_SLOTS


def _sketch(src: DataFrame, k: int) -> np.ndarray:
    """Shingle frequencies over all documents in a sketch of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH_ROWS * SKETCH_SLOTS, np.int64)
        for b in _pieces(batches):
            sets = np.concatenate([shingles(t, k) for t in b.column(0).to_pylist()])
            for at in _slots(sets):
                np.add.at(total, at, 1)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(total[slot])], ["slot", "n"])
    rows = src.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SKETCH_ROWS * SKETCH_SLOTS, np.int64)
    out[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return out


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _signature(s: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(mix(s * _A)).view(np.int64) if len(s) else 0)


def _keep(n: int, percent: int) -> int:
    """Prefix length of a set of n shingles."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _parity(s: np.ndarray) -> bytes:
    """For each of about n to 2n slots whether an odd number of the n shingles falls into it."""
    slots = 1 << max(6, (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1, bitorder="little").tobytes()


def _apart(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the number of shingles that one of two sets has and the other has not,
    from their parities (uint64): each slot where they differ holds such a shingle. The larger
    table is folded; the lowest bits of a hash give its slot."""
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def _close(n: int, m: int, apart: int, percent: int) -> bool:
    """Whether sets of n and m shingles, ``apart`` of which at least are not shared, can link."""
    return 100 * min(n, m) >= percent * max(n, m) and (100 + percent) * (n + m - apart) >= 2 * percent * (n + m)


def _prefixes(src: DataFrame, k: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """(doc_id, n, sig, low, bits, prefix): set size, hash of the set, min-hashes, parities,
    rare-first prefix."""
    shared = src.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = shared.value
        for b in _pieces(batches):
            n, sig, low, bits, pre = [], [], [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(t, k)
                n.append(len(s))
                sig.append(_signature(s))
                low.append([int(mix(s ^ seed).min().view(np.int64)) for seed in _SEEDS] if len(s) else None)
                bits.append(_parity(s))
                weight = np.min([freq[at] for at in _slots(s)], axis=0) if len(s) else s
                pre.append(s[np.lexsort((s, weight))[:_keep(len(s), percent)]])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(low, pa.list_(pa.int64())), pa.array(bits, pa.binary()), _longs(pre)],
                                             ["doc_id", "n", "sig", "low", "bits", "prefix"])
    return src.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, sig long, low array<long>, bits binary, prefix array<long>")


#: Bits of the id filter (2 MB, fixed).
_BITS = 1 << 24


def _texts(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of ``wanted`` (rep, ...). A bit filter of fixed size keeps most other texts out of
    the shuffle; what it lets through wrongly, the join removes."""
    slot = F.xxhash64("id").bitwiseAND(_BITS - 1)
    bits = (wanted.select(F.col("rep").alias("id")).select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(s & 63 AS INT))")).alias("b")).toPandas())
    table = np.zeros(_BITS >> 6, np.int64)
    table[bits["w"].to_numpy()] = bits["b"].to_numpy()
    held = F.broadcast(src.sparkSession.createDataFrame([(table.tolist(),)], "bits array<long>"))
    some = (src.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").bitwiseAND(_BITS - 1).alias("slot"))
            .join(held, F.expr("shiftright(bits[CAST(shiftright(slot, 6) AS INT)], CAST(slot & 63 AS INT)) & 1 = 1")).select("doc_id", "text"))
    return some.join(wanted, some["doc_id"] == wanted["rep"]).drop("doc_id")


def _leaders(members: DataFrame, percent: int, leaders: int) -> DataFrame:
    """(rep, sig, lead, lead_sig): of the members (rep, sig, n, bits, low, part, depth) of a min-hash
    class (and part) those that by their parities can link with a leader, and the closest one. The
    rows stream by, the least ``depth`` first; one that no leader can link becomes one itself, up
    to ``leaders``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lead = None, []
        for b in _pieces(batches):
            found = []
            for low, part, rep, sig, n, bits in zip(*(c.to_pylist() for c in b.columns[:6])):
                if (low, part) != group:
                    group, lead = (low, part), []
                mine = np.frombuffer(bits, np.uint64)
                far = [(_apart(mine, x[3]), x) for x in lead if 100 * min(n, x[2]) >= percent * max(n, x[2])]
                near, best = min(far, key=lambda x: x[0], default=(0, None))
                if best and _close(n, best[2], near, percent):
                    found.append((rep, sig, *best[:2]))
                elif len(lead) < leaders:
                    lead.append((rep, sig, n, mine))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(4)], ["rep", "sig", "lead", "lead_sig"])
    key = ["low", "part"]
    return (members.select(*key, "rep", "sig", "n", "bits", "depth").repartition(*key)
            .sortWithinPartitions(*key, "depth", F.xxhash64("rep"), "rep").mapInArrow(run, "rep long, sig long, lead long, lead_sig long"))


def _shared(entries: DataFrame, percent: int) -> DataFrame:
    """Of the prefix shingles (sig, n, pos, token) those that another set of a size that can
    link has too, once a set. By size, a set's neighbour among a shingle's sets is the closest
    one, so that it is enough to look at the rows before and after."""
    by = Window.partitionBy("token").orderBy("n", "sig")
    entries = (entries.select("*", F.lag("n").over(by).alias("n0"), F.lag("sig").over(by).alias("sig0"))
               .where("n0 is null or n0 <> n or sig0 <> sig").drop("n0", "sig0"))
    return (entries.select("*", F.lag("n").over(by).alias("smaller"), F.lead("n").over(by).alias("larger"))
            .where((100 * F.col("smaller") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("larger"))).drop("smaller", "larger"))


class _Part:
    """Index of the members of one part of a group: {rep: (n, tokens, places, parities)}."""

    def __init__(self, members: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]):
        self.reps = np.fromiter(members, np.int64, len(members))
        self.n = np.array([m[0] for m in members.values()], np.int64)
        tokens = np.concatenate([m[1] for m in members.values()])
        order = np.argsort(tokens, kind="stable")
        self.tokens = tokens[order]
        self.who = np.repeat(np.arange(len(members)), [len(m[1]) for m in members.values()])[order]
        self.at = np.concatenate([m[2] for m in members.values()])[order]
        self.bits = [m[3] for m in members.values()]
        self.hit = np.zeros(len(members), bool)

    def linkable(self, n: int, tokens: np.ndarray, places: np.ndarray, percent: int, whole: bool) -> np.ndarray:
        """Which members can reach the threshold with a set of n shingles, of which ``tokens``
        are at ascending ``places``; ``whole``: these are full sets, so that it is exact."""
        lo, hi = np.searchsorted(self.tokens, tokens), np.searchsorted(self.tokens, tokens, "right")
        count = hi - lo
        mine = np.repeat(np.arange(len(tokens)), count)
        theirs = np.arange(len(mine)) + np.repeat(lo - np.cumsum(count) + count, count)
        who = self.who[theirs]
        most = both = np.bincount(who, minlength=len(self.n))
        if not whole:
            first, last = np.zeros(len(self.n), np.int64), np.zeros(len(self.n), np.int64)
            last[who] = np.arange(len(who))
            first[who[::-1]] = np.arange(len(who))[::-1]
            if len(who):
                # shared shingles outside the prefixes lie behind the last shared one inside them
                behind = np.minimum(n - 1 - places[mine[last]], self.n - 1 - self.at[theirs[last]])
                upper = np.minimum(n - places[mine[first]], self.n - self.at[theirs[first]])
                most = np.minimum(both + behind, upper)
        return (both > 0) & ((100 + percent) * most >= percent * (n + self.n))


def _visits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(key, part, rep, n, tokens, places, bits) for every query of rows (key, kind, rep, n, tokens,
    places, bits), sorted by key and kind: the members of a part (kind 0) come before its queries."""
    key, members, part, last = None, {}, None, None
    for where, kind, rep, n, tokens, places, bits in rows:
        if where != key:
            key, members, part, last = where, {}, None, None
        if kind == 0:
            members.setdefault(rep, (n, tokens, places, bits))
        elif members and rep != last:
            part, last = part or _Part(members), rep
            yield where, part, rep, n, tokens, places, bits


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """(g, part, kind, rep): of the members and queries (g, part, kind, rep, n, bits, tokens, at)
    those that the prefixes and parities leave as possible links, each once a part."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            tokens, at = b.column(6), b.column(7)
            for i, (g, part, kind, rep, n, bits) in enumerate(zip(*(c.to_pylist() for c in b.columns[:6]))):
                yield (g, part), kind, rep, n, tokens[i].values.to_numpy().view(np.uint64), at[i].values.to_numpy().astype(np.int64), np.frombuffer(bits, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, part), held, rep, n, tokens, places, bits in _visits(read(batches)):
            ok = held.linkable(n, tokens, places, percent, False)
            for i in np.flatnonzero(ok):
                ok[i] = _close(n, int(held.n[i]), _apart(bits, held.bits[i]), percent)
            if ok.any():
                fresh = held.reps[ok & ~held.hit]
                held.hit |= ok
                reps = np.append(fresh, rep)
                kind = np.append(np.zeros(len(fresh), np.int32), np.int32(1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(reps), g)), pa.array(np.full(len(reps), part, np.int32)), pa.array(kind), pa.array(reps)],
                                                 ["g", "part", "kind", "rep"])
    rows = rows.select("g", "part", "kind", "rep", "n", "bits", "tokens", "at").repartition("g", "part").sortWithinPartitions("g", "part", "kind", "rep")
    return rows.mapInArrow(run, "g long, part int, kind int, rep long")


def _verified(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (u, v) between the queries and members (g, part, kind, rep, sig, text) of each part,
    by their full sets: one for each query and part, whose members are connected already. A row whose set lacks the hash ``sig`` or that is repeated is passed over."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in _pieces(batches):
            for g, part, kind, rep, sig, text in zip(*(c.to_pylist() for c in b.columns)):
                if _signature(s := shingles(text, k)) == sig:
                    yield (g, part), kind, rep, len(s), s, np.zeros(len(s), np.int64), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, rep, n, tokens, places, _ in _visits(read(batches)):
            v = held.reps[held.linkable(n, tokens, places, percent, True)]
            if len(v):
                yield pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array(v[:1])], ["u", "v"])
    rows = texts.select("g", "part", "kind", "rep", "sig", "text").repartition("g", "part").sortWithinPartitions("g", "part", "kind", "rep")
    return rows.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, leaders: int = 64, class_part: int = 2000, part_shingles: int = 1 << 21, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, rep, component_id) per row of ``docs``: set size, the smallest
    doc_id with the same set, the smallest doc_id reachable by links.

    A document without words (null, empty, only white space) has an empty set, links with
    nothing and is its own component. Rows with a null id are returned with null components
    and link with nothing. Repeated rows are copies. Other columns are not read. Texts of any
    length are read whole; a set is held by one task at a time.
    """
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    rows = cut(_prefixes(src, k, percent, _sketch(src, k)))
    reps = rows.where("n > 0 and doc_id is not null").groupBy("sig", "n").agg(F.min("doc_id").alias("rep"), F.any_value("low").alias("low"), F.any_value("bits").alias("bits"))

    # 1. prefix shingles that sets of similar size share
    entries = _shared(rows.where("n > 0 and doc_id is not null and sig is not null").select("sig", "n", F.posexplode("prefix").alias("pos", "token")), percent)
    entries = cut(entries.join(reps.select("sig", "n", "rep"), ["sig", "n"]).select("rep", "sig", "n", "pos", "token"))

    # 2. groups of similar documents
    first = entries.groupBy("rep", "sig").agg(F.min(F.col("pos") / F.col("n")).alias("depth"))
    sets = cut(first.join(reps, ["rep", "sig"]).select("rep", "sig", "n", "bits", "low", "depth"))
    met = sets.select("rep", "sig", "n", "bits", "depth", F.explode("low").alias("low"))
    # a table of its own, so that a frequent class is split in the join
    parts = cut(met.groupBy("low").agg(F.count("*").alias("c")).where("c > 1").select("low", F.ceil(F.col("c") / class_part).cast("int").alias("parts")))
    known = met.join(parts, "low").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    near = cut(_leaders(known, percent, leaders))
    # the leader of a class part is a part of one member, its class part the queries
    pairs = near.select("lead", "lead_sig", "rep", "sig").distinct()
    visits = (pairs.select(F.col("lead").alias("g"), F.lit(0).alias("kind"), F.col("lead").alias("rep"), F.col("lead_sig").alias("sig")).distinct()
              .unionByName(pairs.select(F.col("lead").alias("g"), F.lit(1).alias("kind"), "rep", "sig")))
    links = cut(_verified(_texts(src, visits.withColumn("part", F.lit(0))), k, percent))

    # sets with their group, the members of a group and the parts it is read in
    def groups(links):
        label = components(links)
        grouped = (entries.select("rep", "n").distinct().join(label.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("rep", "n", F.coalesce("root", "rep").alias("g")))
        size = grouped.groupBy("g").agg(F.count("*").alias("members"), F.ceil(F.sum("n") / part_shingles).cast("int").alias("parts"))
        return cut(grouped.join(size, "g"))

    # members of opened groups and the queries that open them
    one = sets.select("rep", "sig", "n", "bits").dropDuplicates(["rep"])
    held = (entries.groupBy("rep", "sig").agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("p"))
            .select("rep", "sig", F.col("p.token").alias("tokens"), F.col("p.pos").alias("at")).join(one, ["rep", "sig"]))
    held = cut(held)

    def linked(grouped, opened):
        opened = cut(opened)
        members = (grouped.join(opened.select("g").distinct(), "g", "left_semi")
                   .select("g", F.pmod(F.xxhash64("rep"), "parts").cast("int").alias("part"), F.lit(0).alias("kind"), "rep"))
        queries = opened.select("g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"), "rep")
        found = cut(_candidates(members.unionByName(queries).join(held, "rep"), percent))
        return cut(_verified(_texts(src, found.join(one.select("rep", "sig"), "rep")), k, percent))

    # 3. every set meets the largest of the groups that its shingles are in
    grouped = groups(links)
    e = entries.select("rep", "token").join(grouped.select("rep", "g", "members", "parts"), "rep")
    largest = e.select("rep", "g", F.max(F.struct("members", "g", "parts")).over(Window.partitionBy("token")).alias("m")).where("g <> m.g")
    links = links.unionByName(linked(grouped, largest.groupBy("rep").agg(F.max("m").alias("m")).select("rep", "m.g", "m.parts")))

    # 4. token-group matrix; the query comes from the smaller of two groups
    grouped = groups(links)
    e = entries.select("rep", "pos", "token").join(grouped, "rep")
    matrix = e.groupBy("token", "g", "members", "parts").agg(F.min("pos").alias("pos"), F.min("n").alias("n_min"), F.max("n").alias("n_max"))

    def may_link(n, pos, other_pos, other_low, other_high):
        """Whether a set of n shingles can link with one of a size from ``other_low`` to
        ``other_high`` if the first shingle that they share has these places."""
        low = F.greatest(other_low, F.ceil((percent * n + (100 + percent) * other_pos) / 100))
        high = F.least(other_high, F.floor((100 + percent) * (n - pos) / percent) - n)
        return low <= high

    q, m = e.alias("q"), matrix.alias("m")
    smaller = (F.col("q.members") < F.col("m.members")) | ((F.col("q.members") == F.col("m.members")) & (F.col("q.g") < F.col("m.g")))
    pair = linked(grouped, q.join(m, (F.col("q.token") == F.col("m.token")) & (F.col("q.g") != F.col("m.g")) & smaller
                                  & may_link(F.col("q.n"), F.col("q.pos"), F.col("m.pos"), F.col("m.n_min"), F.col("m.n_max")))
                  .select("q.rep", "m.g", "m.parts").distinct())
    label = components(links.unionByName(pair))

    home = reps.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("sig", "n", "rep", F.coalesce("root", "rep").alias("root"))
    out = rows.select("doc_id", "n", "sig").join(home, ["sig", "n"], "left")
    own = F.col("n") == 0
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(own, F.col("doc_id")).otherwise(F.col("rep")).alias("rep"),
                      F.when(own | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("root")).alias("component_id"))
