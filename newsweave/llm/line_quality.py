"""Operator 8: quality classifier, a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line's features are its own statistics and
those of its two neighbours, so a line is judged in context, and a transition matrix ties the
labels of neighbouring lines. Forward-backward gives each line's marginal of being good; the
marginals, weighted by line length, make the document's score.

Training uses the document's label for all of its lines (the only labels there are) and
maximises the conditional log-likelihood of a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bound of the training sample: documents of each label, lines of one document.
SAMPLE_DOCS, SAMPLE_LINES = 600, 40
_SYMBOL = re.compile(r"[#*$%&|<>{}\[\]~^=_\\@+]")
_UPPER, _DIGIT = re.compile(r"[A-Z\u00c0-\u00d6\u00d8-\u00de\u0391-\u03ab\u0410-\u042f]"), re.compile(r"\d")
N_OWN = 12


def line_features(lines: list[str]) -> np.ndarray:
    """Statistics of each line: length, word length, shares of capitals, digits, symbols and
    exclamation marks, punctuation, repeated words, and whether an earlier line is the same."""
    out = np.zeros((len(lines), N_OWN))
    seen: set[str] = set()
    for i, line in enumerate(lines):
        words = line.split()
        n, w = len(line), len(words)
        if not w:
            out[i, 11] = 1.0
            continue
        letters = sum(map(len, words))
        different = len(set(line.lower().split()))
        out[i, :11] = (min(np.log1p(w), 6.0) / 3, min(letters / w, 30.0) / 10, len(_UPPER.findall(line)) / letters, len(_DIGIT.findall(line)) / letters,
                       min(1.0, 4 * len(_SYMBOL.findall(line)) / letters), min(1.0, 10 * line.count("!") / letters),
                       (line.count(".") + line.count(",")) / w, 1 - different / w if w > 7 else 0.0, line in seen, w < 4, n > 2000)
        seen.add(line)
    return out


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features per line with context and a constant, line weights). A null or empty text is
    one empty line."""
    lines = (text or "").split("\n")
    own = line_features(lines)
    pad = np.zeros((1, N_OWN))
    around = np.concatenate((own, np.concatenate((pad, own[:-1])), np.concatenate((own[1:], pad)),
                             np.broadcast_to(own.mean(0), own.shape), np.ones((len(lines), 1))), 1)
    return around, np.array([len(x) for x in lines], float) + 1e-6


N_FEATURES = 4 * N_OWN + 1


def marginals(scores: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward for one chain: node marginals (n, 2), summed edge marginals (2, 2),
    log of the normaliser. ``scores`` are (n, 2) log potentials, ``trans`` is (2, 2)."""
    n = len(scores)
    top = scores.max(1)
    node = np.exp(scores - top[:, None])
    (t00, t01), (t10, t11) = step = np.exp(trans).tolist()
    rows = node.tolist()
    fwd, bwd, scale = [], [(1.0, 1.0)], []
    a0, a1 = rows[0]
    for i in range(n):
        if i:
            a0, a1 = (a0 * t00 + a1 * t10) * rows[i][0], (a0 * t01 + a1 * t11) * rows[i][1]
        c = a0 + a1
        a0, a1 = a0 / c, a1 / c
        fwd.append((a0, a1))
        scale.append(c)
    b0 = b1 = 1.0
    for i in range(n - 1, 0, -1):
        e0, e1 = rows[i][0] * b0 / scale[i], rows[i][1] * b1 / scale[i]
        b0, b1 = t00 * e0 + t01 * e1, t10 * e0 + t11 * e1
        bwd.append((b0, b1))
    f, g, z = np.array(fwd), np.array(bwd[::-1]), np.array(scale)
    p = f * g
    edges = np.zeros((2, 2))
    if n > 1:
        edges = np.array(step) * (f[:-1].T @ (node[1:] * g[1:] / z[1:, None]))
    return p / p.sum(1, keepdims=True), edges, float(np.log(z).sum() + top.sum())


def fit(sample: list[tuple[np.ndarray, int]], rounds: int = 50, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights (features, 2), transitions (2, 2)) by Adam on whole-sample gradients. Each
    document counts once whatever its number of lines, and both labels weigh the same."""
    w, t = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    if not sample:
        return w, t
    n_of = [max(1, sum(y == k for _, y in sample)) for k in (0, 1)]
    m = [np.zeros_like(w), np.zeros_like(t)]
    v = [np.zeros_like(w), np.zeros_like(t)]
    for r in range(1, rounds + 1):
        gw, gt = l2 * w, l2 * t
        for x, y in sample:
            p, e, _ = marginals(x @ w, t)
            gold = np.zeros(2)
            gold[y] = 1.0
            c = 0.5 / n_of[y] / len(x)
            gw = gw + c * (x.T @ (p - gold))
            ge = e.copy()
            ge[y, y] -= len(x) - 1
            gt = gt + c * ge
        for k, (par, g) in enumerate(((w, gw), (t, gt))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            par -= 0.15 * (m[k] / (1 - 0.9 ** r)) / (np.sqrt(v[k] / (1 - 0.999 ** r)) + 1e-8)
    return w, t


def score(text: str | None, model: tuple[np.ndarray, np.ndarray]) -> float:
    x, weight = document_features(text)
    p = marginals(x @ model[0], model[1])[0][:, 1]
    return float(min(1.0, max(0.0, (p * weight).sum() / weight.sum())))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """Model from at most ``sample_docs`` documents of each label (smallest id hash first) and
    ``SAMPLE_LINES`` lines of each, spread evenly over the document. ``labels`` has one row per
    labelled id; of several, the smallest label counts, and labels other than 0 and 1 are not
    used. Repeated documents count once.

    The sample is drawn from ids alone; only its few rows are sent to one scan of the texts. The
    tasks compute the features, the driver fits the bounded sample."""
    marks = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    there = marks.join(docs.select(docs[id_col].alias("id")), "id", "left_semi")
    order = F.xxhash64(F.col("id").cast("string"), F.lit(23))
    pick = [there.where(F.col("y") == y).select("id", "y", order.alias("h")).orderBy("h", "id").limit(sample_docs).select("id", "y") for y in (0, 1)]
    # at most 2 * sample_docs rows
    chosen = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(pick[0].unionByName(pick[1])), "id").dropDuplicates(["id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [x[np.unique(np.linspace(0, len(x) - 1, SAMPLE_LINES).astype(int))] for x in (document_features(t)[0] for t in b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.float32).tobytes() for x in xs], pa.binary()), b.column(1)], ["x", "y"])
    got = chosen.select("text", "y").mapInArrow(run, "x binary, y int").collect()
    sample = sorted((bytes(r["x"]), r["y"]) for r in got)
    return fit([(np.frombuffer(x, np.float32).reshape(-1, N_FEATURES).astype(float), y) for x, y in sample])


def classify(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0..1) and predicted (1 if score >= threshold). Whole texts are
    scored; null and empty texts are scored as one empty line. Other columns are kept and
    never looked at; columns of these two names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted")
    cols = docs.columns
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [score(t, shared.value) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())], [*cols, "score", "predicted"])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
