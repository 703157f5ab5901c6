"""Vector codes, fill-in-middle and spot signatures against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsweave.llm import fill_in_middle as FIM
from newsweave.llm import spot_signatures as SPOT
from newsweave.llm import vector_codes as VC


# --- vector codes -----------------------------------------------------------------------------
def lloyd(rows, parts=8, entries=16, rounds=6):
    """rows: (id, integer vector), in codebook order first."""
    q = np.array([v for _, v in rows], dtype=object)
    width = q.shape[1] // parts
    code, error = np.zeros((len(q), parts), int), np.zeros(len(q), dtype=object)
    books = []
    for p in range(parts):
        x = q[:, p * width:(p + 1) * width]
        book = [list(v) for v in x[:entries]]
        for k in range(rounds + 1):
            d = [[sum((a - b) ** 2 for a, b in zip(v, e)) for e in book] for v in x]
            near = [min(range(len(book)), key=lambda j: (r[j], j)) for r in d]
            if k < rounds:
                for j in range(len(book)):
                    mine = [v for v, n in zip(x, near) if n == j]
                    if mine:
                        book[j] = [sum(c) // len(mine) for c in zip(*mine)]
        code[:, p] = near
        error = error + np.array([r[j] for r, j in zip(d, near)], dtype=object)
        books.append(book)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return ["".join(f"{c:02x}" for c in r) for r in code], [int(e) for e in error], sha


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    v = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * rng.choice([0.0, 0.01, 1.0], (n, 1))
    return v.astype(np.float32).astype(float)


@pytest.mark.parametrize("block_rows,leaf,labels", [(4096, 32, 10), (7, 2, 0)])
def test_codes_equal_brute_force(spark, block_rows, leaf, labels):
    v = vectors(120, 16, 3)
    rows = [(1000 - 3 * i, [float(x) for x in r], None if i % 5 == 0 else i % 3, "z") for i, r in enumerate(v)]
    rows += [rows[7], rows[7], (2000, None, 1, "z"), (2001, [None] + [1.0] * 15, 1, "z"), (2002, [float("nan")] * 16, 1, "z"), (2003, [float("-inf")] * 16, 1, "z")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string").repartition(3)
    kept = sorted((r for r in rows if r[1] and None not in r[1] and np.isfinite(r[1]).all()), key=lambda r: (r[0], r[1]))
    codes, errors, sha = lloyd([(r[0], [int(np.floor(4096 * x)) for x in r[1]]) for r in kept])
    sums = {}
    for r, e in zip(kept, errors):
        sums[r[2]] = sums.get(r[2], 0) + e
    got = VC.compress(df, block_rows=block_rows, leaf=leaf, broadcast_labels=labels)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted((r[0], c, e, sums[r[2]], sha) for r, c, e in zip(kept, codes, errors))


def test_codes_of_odd_vectors(spark):
    """Short vectors end in zeros, huge components are limited, null ids come last."""
    rows = [(None, [1.0] * 9, None), (5, [1e30] * 9, 1), (4, [-1e30] * 9, 1), (3, [0.5], 2), (2, [], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in VC.compress(df).collect()}
    # nine components are padded to two in each of eight parts; five rows make five entries
    assert set(got) == {None, 5, 4, 3, 2} and all(len(r.code) == 16 for r in got.values())
    assert got[2].code == "00" * 8 and got[3].error == 0 and got[5].label_error == got[5].error + got[4].error == 0
    assert VC.compress(df.limit(0)).count() == 0
    assert VC.compress(df.where("vec_id = 5")).first().code == "00" * 8


def test_whole_nodes_and_uncertain_leaves():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(-50, 50, (300, 4)), rng.integers(5000, 5100, (300, 4)), np.zeros((40, 4), np.int64)])
    entries = np.array([[0, 0, 0, 0], [5050, 5050, 5050, 5050], [1, 0, 0, 0], [0, 0, 0, 0], [90_000, 0, 0, 0]])
    tree = VC.build(points, 8)
    node, entry, leaf, possible = VC.descend(tree, entries)
    covered = np.concatenate([VC._places(tree, node), VC._places(tree, np.unique(leaf))])
    assert sorted(covered) == list(range(len(points))) and set(entry) == {1} and 4 not in possible
    d = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    sums, counts, mine, error = VC.assign(tree, entries, labels=True)
    assert (mine == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all() and (counts == np.bincount(mine, minlength=5)).all()
    assert all((sums[k] == points[mine == k].sum(axis=0)).all() for k in range(5))
    back = VC._unpack(VC._pack(tree), 4)
    assert back.depth == tree.depth and all((getattr(back, a) == getattr(tree, a)).all() for a in VC._ARRAYS)


# --- fill-in-middle ---------------------------------------------------------------------------
def fim(doc, text, seed=1):
    text = text or ""
    n, h = len(text), hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:z], text[z:]
    return (n, "spm", a, z - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, z - a, f"<P>{p}<S>{s}<M>{m}")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_fill_in_middle_equals_brute_force(spark, odd, none):
    rows = [(i, ("aé漢😀 \n" * (i % 9)) + ["", "<P>", "<S", "x<M>y", "<P"][i % 5]) for i in range(200)]
    rows += [(500, "é" * (FIM.STEP + 5)), (501, "ab漢" * FIM.STEP), (502, "plain ascii " * 9000)]
    docs = odd.select("doc_id", "text", "score", "rep").unionByName(spark.createDataFrame([(*r, None, "n") for r in rows], "doc_id long, text string, score string, rep string"))
    docs = docs.withColumnRenamed("rep", "form").withColumnRenamed("score", "n")
    want = [(r.doc_id, *fim(r.doc_id, r.text)) for r in docs.collect()]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    out = FIM.transform(docs)
    key = str
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert sorted(map(tuple, FIM.restore(out).collect()), key=key) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=key)
    texts = {(r.doc_id, sha(r.text or "")) for r in docs.collect()}
    got = FIM.digests(docs).collect()
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) for r in got), key=key) == sorted(((*w[:5], sha(w[5])) for w in want), key=key)
    assert {(r.doc_id, r.restored_sha256) for r in got} == texts
    assert FIM.digests(none).count() == FIM.transform(none).count() == FIM.restore(FIM.transform(none)).count() == 0


# --- spot signatures --------------------------------------------------------------------------
def spots(text, chain=SPOT.CHAIN):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    anchors = set(SPOT.ANCHORS)
    content = [x for x in w if x not in anchors]
    found = {" " + " ".join((content or w)[:chain])} if w else set()
    for i, x in enumerate(w):
        if x in anchors and (after := [y for y in w[i + 1:] if y not in anchors][:chain]):
            found.add(" ".join([x, *after]))
    return {hashlib.md5(s.encode()).hexdigest()[:8] for s in found}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signatures_equal_brute_force(spark):
    texts = ["The cat sat on the mat and the dog of a house barked", "the of and", "", None, "lonely", "of x", "x of", "THE Ünï 漢字 of 😀! a-b", " \n "] + [
        " ".join(np.random.default_rng(i).choice(["the", "of", "und", "stone", "river", "7", "é"], 40)) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for chain in (1, 2, 3):
        got = {r.i: r.s for r in df.select("i", SPOT.signatures(df["t"], chain).alias("s")).collect()}
        assert all(got[i] == sorted(spots(t, chain)) for i, t in enumerate(texts))


def test_edited_neighbours_equal_brute_force(spark, odd, none):
    base = "the river of stones and a bridge is built by the men of that town "
    rows = [(i, f"{base * (i % 7)} tail {i} of the story {i % 3}") for i in range(100, 160)] + [(155, "another text of the same id"), (-5, "ab"), (120, f"{base}")]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("n", F.lit("z"))
    order = spark.createDataFrame(docs.collect(), docs.schema).selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(doc_id IS NULL, coalesce(text, '')) AS h").collect()
    order.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h), reverse=True)
    want = []
    for k, r in enumerate(order):
        after, n = order[(k + 1) % len(order)], len(r.text)
        edited = r.text[:n - n // 3] + after.text[:n // 3]
        a, b, c = spots(r.text), spots(edited), spots(after.text)
        want.append((r.doc_id, n, sha(edited), "".join(sorted(a)), "".join(sorted(b)), round(likeness(a, b), 9), round(likeness(a, c), 9)))
    got = [(*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in SPOT.edited_neighbours(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert SPOT.edited_neighbours(none).count() == 0
    one = SPOT.edited_neighbours(spark.createDataFrame([(1, "the river of stones")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.n_chars == 19


def test_search_equals_brute_force(spark, none):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)] + ["the", "of", "und"] * 60
    texts = []
    for i in range(12):
        w = list(rng.choice(words, int(rng.integers(5, 120))))
        for cut in (0, 0, 1, 3, 9):
            v = list(w)
            for at in rng.integers(0, len(v), cut):
                v[at] = f"new{rng.integers(1 << 30)}"
            texts.append(" ".join(v))
    rows = list(enumerate([*texts, None, "", "!!"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (0.8, 0.5):
        want = {(i, j) for i, a in rows for j, b in rows if i % 5 == 0 and spots(a) and spots(b) and likeness(spots(a), spots(b)) >= least}
        got = SPOT.search(df.where("doc_id % 5 = 0"), df, least).collect()
        assert {(r.query_id, r.doc_id) for r in got} == want and len(got) == len(want)
    assert SPOT.search(none, df).count() == SPOT.search(df, none).count() == 0
