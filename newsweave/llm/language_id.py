"""Operator 6: language identification by compression.

For every language a raw-content zstandard dictionary is filled from a bounded sample of
labelled rows. A whole text, reduced to lower-case letters and single blanks, is compressed
block by block with each language's dictionary; the language with the fewest bytes wins. Small
blocks keep the dictionary in play: a long text would otherwise soon serve as its own. The
few bytes of a short text are too coarse a measure, so there the sizes of the text from each
of its words to its end are added up, at a stronger compression level. Classification is
rejected where the margin between the two best languages is narrower than nearly all margins of
texts of that length in a learned language: one row in FIT_EVERY of the training sample is kept
out of the dictionaries, and a low quantile of its margins, at several lengths, is the limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bound of the training sample: rows per language, characters of a row's letters, bytes.
SAMPLE_ROWS, ROW_CHARS, DICT_BYTES = 300, 1000, 50_000
#: Bytes that are compressed at a time; texts up to SHORT bytes are measured more finely.
BLOCK, SHORT = 600, 160
LEVEL, SHORT_LEVEL = 5, 12
#: One sampled row in FIT_EVERY fits the margins, cut to each of FIT_LENGTHS bytes of which
#: FIT_ROWS rows are that long; the limit is the quantile FIT_SHARE of the right language's
#: margin. PLAIN is the limit where no row could be kept out to fit one.
FIT_EVERY, FIT_SHARE, FIT_ROWS, PLAIN = 3, 0.01, 20, 0.001
FIT_LENGTHS = (8, 16, 32, 64, 128, 256, 512, 1000)
_NOT_LETTERS, _LETTER = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\p{L}")


def letters(text: str) -> str:
    """Runs of letters with their marks, lower-cased, joined by one blank; empty without a
    letter (marks and other numerals such as fractions are none)."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip() if _LETTER.search(text) else ""


class Model(dict):
    """{language: dictionary content} with ``limits``, [(bytes of letters, least margin)]."""

    def __init__(self, content=(), limits=()):
        super().__init__(content)
        self.limits = list(limits)

    def __reduce__(self):
        return Model, (dict(self), self.limits)

    def least(self, size: int) -> float:
        """The least margin of a text of ``size`` bytes, linear in the logarithm of the size."""
        at = [x for x, _ in self.limits]
        if not at:
            return PLAIN
        k = sum(x <= size for x in at)
        if k == 0 or k == len(at):
            return self.limits[min(k, len(at) - 1)][1]
        (a, low), (b, high) = self.limits[k - 1], self.limits[k]
        return low + (high - low) * math.log(size / a) / math.log(b / a)


def _limits(content: dict[str, bytes], kept: dict[str, list[str]]) -> list[tuple[int, float]]:
    """Margin limits from texts of known language outside the dictionaries."""
    judge, out = Classifier(content), []
    if len(content) < 2:
        return out
    for size in FIT_LENGTHS:
        margins = []
        for k, lang in enumerate(judge.langs):
            for text in kept.get(lang, ()):
                data = text.encode("utf-8", "ignore")
                if len(data) >= size:
                    sizes = judge.sizes(data[:size].decode("utf-8", "ignore").strip().encode())
                    other = min(s for i, s in enumerate(sizes) if i != k)
                    margins.append((other - sizes[k]) / other)
        if len(margins) >= FIT_ROWS:
            out.append((size, max(0.0, sorted(margins)[int(FIT_SHARE * len(margins))])))
    return out


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, dict_bytes: int = DICT_BYTES, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """{language: dictionary content}, the most frequent language first, from at most
    ``sample_rows`` rows of each language (those with the smallest hash of their id), and the
    margin limits from the sampled rows whose text is in no dictionary. Rows with null text or language, and texts without letters, are not used."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    count = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    w = Window.partitionBy("lang").orderBy("h", "id")
    pick = (rows.select("lang", "id", F.xxhash64(F.col("id").cast("string"), F.lit(11)).alias("h"))
            .withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample_rows).select("lang", "id", "r"))
    # the sample has sample_rows rows a language at most, so it is small enough to broadcast
    texts = (rows.join(F.broadcast(pick), ["lang", "id"]).dropDuplicates(["lang", "r"])
             .select("lang", "r", F.substring("text", 1, 4 * ROW_CHARS).alias("text")).orderBy("lang", "r").collect())
    parts: dict[str, list[str]] = {}
    kept: dict[str, list[str]] = {}
    for r in texts:
        (kept if r["r"] % FIT_EVERY == 0 else parts).setdefault(r["lang"], []).append(letters(r["text"])[:ROW_CHARS])
    order = sorted(parts, key=lambda k: (-count[k], k))
    learned = {x for p in parts.values() for x in p}
    kept = {k: [x for x in v if x not in learned] for k, v in kept.items()}
    content = {k: " ".join(parts[k]).encode("utf-8", "ignore")[:dict_bytes] for k in order}
    return Model(content, _limits(content, kept))


class Classifier:
    def __init__(self, content: dict[str, bytes]):
        self.langs = list(content)
        self.coders, self.fine = ([self._coder(content[k], level, size) for k in self.langs] for level, size in ((LEVEL, BLOCK), (SHORT_LEVEL, SHORT)))

    @staticmethod
    def _coder(content: bytes, level: int, size: int) -> zstandard.ZstdCompressor:
        kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(level, source_size=size, dict_size=len(content), write_content_size=False,
                                                                write_checksum=False, write_dict_id=False)
        kind.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=kind, compression_params=params)

    def sizes(self, data: bytes) -> list[int]:
        """Compressed bytes of the letters with each language's dictionary."""
        if len(data) <= SHORT:
            coders = self.fine
            parts = [data, *(data[k + 1:] for k, c in enumerate(data) if c == 32)]
        else:
            coders = self.coders
            step = -(-len(data) // -(-len(data) // BLOCK))
            parts = [data[k:k + step] for k in range(0, len(data), step)]
        return [sum(map(len, map(c.compress, parts))) for c in coders]

    def predict(self, text: str | None) -> tuple[str, float, float, int]:
        """(language, score, margin, bytes of letters): margin is the share of bytes that the best language
        saves against the second best, score maps it to 0..1. A text that is null or has no
        letter, or an untrained classifier, gives ('und', 0, 0, bytes). Ties go to the language with
        more labelled rows."""
        data = letters(text).encode("utf-8", "ignore") if text else b""
        if not data or not self.langs:
            return "und", 0.0, 0.0, len(data)
        if len(self.langs) == 1:
            return self.langs[0], 1.0, 1.0, len(data)
        sizes = self.sizes(data)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min(s for k, s in enumerate(sizes) if k != best)
        margin = (second - sizes[best]) / second
        return self.langs[best], min(1.0, 0.5 + 5 * margin), margin, len(data)


def classify(docs: DataFrame, content: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0..1) and accepted: false for 'und' and for margins
    below the limit of ``content`` for texts of that length. Every other column is kept and
    never looked at; columns of these three names are replaced. An empty table stays empty,
    repeated rows get equal answers."""
    shared = docs.sparkSession.sparkContext.broadcast(content if isinstance(content, Model) else Model(content))
    docs = docs.drop("lang_pred", "score", "accepted")
    cols = docs.columns
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(shared.value)
        for b in batches:
            rows = [judge.predict(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                                              pa.array([r[0] != "und" and r[2] >= shared.value.least(r[3]) for r in rows], pa.bool_())],
                                             [*cols, "lang_pred", "score", "accepted"])
    kinds = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                          T.StructField("accepted", T.BooleanType())])
    return docs.mapInArrow(run, kinds)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
