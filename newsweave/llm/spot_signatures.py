"""Operator 13: document fingerprints by spot signatures, built-in functions only.

Words are runs of letters and digits, lower-cased. Common words of four languages are anchors; a
signature is an anchor with the next ``chain`` content words (words that are no anchors) after
it. The fingerprint of a text is the set of its signatures: local changes touch only the few
chains that cross them, and chains anchored in prose pass by menus and boilerplate, which hold
few anchors. Sets are compared by Jaccard similarity; two sets whose lengths lie in partitions
too far apart cannot reach a wanted likeness and are not compared.

Signatures are 32-bit values from md5, so any engine can repeat them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Common function words of English, German, French and Spanish.
ANCHORS = tuple(
    "the of and to a in is that it for was on with be by as this are at from or an not but have has had were which "
    "der die und den von zu das mit sich auf des für ist nicht dem im ein als eine auch es werden aus er hat dass sie nach wird bei "
    "de la le et les en un du une que pour est qui par dans sur au pas avec plus ce il sont ne se ou son "
    "el y los del las por no con su para al lo como más pero sus fue este".split())
#: Content words in a signature.
CHAIN = 2
WORDS = r"[a-z0-9\x80-\x{10FFFF}]+"
_HEX = 8


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda argument is a bound value."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def signatures(text: Column, chain: int = CHAIN, anchors: tuple[str, ...] = ANCHORS) -> Column:
    """Sorted distinct signatures of a text, as strings of eight hex digits.

    The start of a text counts as an anchor, so a text with words has a signature (without any
    content word, its first words make one); chains at the end may be shorter, down to one word.
    A null text, or one without words, has no signature.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORDS})"), 1)

    def spots(w: Column) -> Column:
        # anchor k (from 0) at place i has i - k content words before it
        at = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: s["x"].isin(*anchors))
        content = F.filter(w, lambda x: ~x.isin(*anchors))
        return _let(content, lambda c: F.concat(
            F.array(F.concat_ws(" ", F.lit(""), F.slice(F.when(F.size(c) > 0, c).otherwise(w), 1, chain))),
            F.filter(F.transform(at, lambda s, k: F.when(s["i"] - k < F.size(c), F.concat_ws(" ", s["x"], F.slice(c, s["i"] - k + 1, chain)))), lambda s: s.isNotNull())))

    found = _let(words, lambda w: F.when(F.size(w) > 0, F.transform(spots(w), lambda s: F.substring(F.md5(s), 1, _HEX))).otherwise(F.array().cast("array<string>")))
    return F.sort_array(F.array_distinct(found))


def length_partition(n: Column, least: float) -> Column:
    """Partition of a set of ``n`` signatures: sets of likeness ``least`` or more lie in the same
    or in neighbouring ones. Empty sets have none."""
    return F.when(n > 0, F.floor(F.log(n.cast("double")) / (-math.log(least) * (1 + 1e-9))).cast("int"))


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sorted sets; two empty ones are alike, an empty one and another
    are not. Where the lengths, or the smallest and largest members, rule out ``least``, the
    sets are not opened and the result is 0."""
    na, nb = F.size(a), F.size(b)
    first, last = F.lit(1), F.lit(-1)
    apart = (F.try_element_at(a, last) < F.try_element_at(b, first)) | (F.try_element_at(b, last) < F.try_element_at(a, first))
    return (F.when((na == 0) & (nb == 0), F.lit(1.0)).when((na == 0) | (nb == 0), F.lit(0.0))
            .when(F.least(na, nb) < F.lit(least) * F.greatest(na, nb), F.lit(0.0)).when(apart, F.lit(0.0))
            .otherwise(_let(F.size(F.array_intersect(a, b)), lambda shared: shared / (na + nb - shared))))


def fingerprint(sigs: Column) -> Column:
    """The set as one string: its members, ascending, joined."""
    return F.array_join(sigs, "")


def search(queries: DataFrame, docs: DataFrame, least: float = 0.8, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, doc_id, likeness) of all documents whose fingerprint has at least ``least``
    likeness with that of a query; a stated set of queries against all rows.

    Two sets can only qualify in neighbouring length partitions, and if they share a member of
    the query's prefix (its first n - ceil(least * n) + 1 members in a fixed order). Documents
    send their members of each partition, queries their prefixes; pairs that share one are
    compared once. Texts without words qualify with nothing. Repeated rows are found each.
    """
    def sets(df, name):
        s = df.select(df[id_col].cast("long").alias(name), signatures(df[text_col], chain).alias("sigs"))
        s = s.withColumn("n", F.size("sigs")).where("n > 0")
        # equal sets are one: the group of its rows is joined back at the end
        return s.withColumn("band", length_partition(F.col("n"), least)).withColumn("key", F.sha2(fingerprint(F.col("sigs")), 256))
    q, d = cut(sets(queries, "query_id")), cut(sets(docs, "doc_id"))
    one = ["key", "sigs", "n", "band"]
    qs, ds = q.select(*one).dropDuplicates(["key"]), d.select(*one).dropDuplicates(["key"])
    prefix = F.slice("sigs", 1, (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))
    probes = qs.select(F.col("key").alias("qk"), F.explode(prefix).alias("sig"), F.explode(F.array("band")).alias("b")).select("qk", "sig", F.explode(F.array(F.col("b") - 1, F.col("b"), F.col("b") + 1)).alias("band"))
    met = ds.select(F.col("key").alias("dk"), "band", F.explode("sigs").alias("sig")).join(probes, ["band", "sig"]).select("qk", "dk").distinct()
    pair = (met.join(qs.select(F.col("key").alias("qk"), F.col("sigs").alias("a")), "qk").join(ds.select(F.col("key").alias("dk"), F.col("sigs").alias("b")), "dk")
            .select("qk", "dk", jaccard(F.col("a"), F.col("b"), least).alias("likeness")).where(F.col("likeness") >= least))
    return (pair.join(q.select(F.col("key").alias("qk"), "query_id"), "qk").join(d.select(F.col("key").alias("dk"), "doc_id"), "dk")
            .select("query_id", "doc_id", "likeness"))


def _neighbours(keys: DataFrame) -> DataFrame:
    """``keys`` (id, id0, h, n, copies; unique in id0 and h) with the key of the next row in
    descending order as next_id0 and next_h; after the last comes the first.

    Keys are range-partitioned and numbered by partition and place; only counts per partition
    are broadcast. No task holds more than its range.
    """
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (keys.repartitionByRange(parts, F.col("id").asc_nulls_first(), "h").sortWithinPartitions(F.col("id").asc_nulls_first(), "h")
              .withColumn("at", F.monotonically_increasing_id()))
    placed = cut(placed.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = placed.groupBy("part").agg(F.count("*").alias("size")).collect()  # one row per partition
    total, before = 0, {}
    for r in sorted(sizes, key=lambda r: r["part"]):
        before[r["part"]] = total
        total += r["size"]
    starts = spark.createDataFrame(list(before.items()) or [(0, 0)], "part long, before long")
    placed = placed.join(F.broadcast(starts), "part").withColumn("place", F.col("before") + F.col("at"))
    right = placed.select(F.col("id0").alias("next_id0"), F.col("h").alias("next_h"), F.pmod(F.col("place") + 1, F.lit(max(total, 1))).alias("place"))
    return placed.join(right, "place").select("id", "id0", "h", "n", "copies", "next_id0", "next_h")


def edited_neighbours(docs: DataFrame, share: int = 3, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next.

    The edited text is the text with its last floor(n_chars / share) code points replaced by the
    first as many (or all) of the next document in descending doc_id; the last document is
    followed by the first, a single one by itself. Null texts count as empty. Null ids come after
    all others. Rows of one id follow each other by a hash of their text (descending); repeated
    rows are each other's next, and the last of them has the next other row. Two texts without
    words are alike (1), an empty one and another are not (0). Other columns are not read.

    Whole texts are shuffled once, by id and text hash, and a third of them once more to the row
    whose edit needs them, with the signatures of their document. No key is shared by more than
    the copies of one row, which are collapsed before the shuffle.
    """
    # a row's key is (id0, h), never null, so that one shuffle serves the copies and both joins
    src = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    src = src.select(F.coalesce("id", F.lit(0).cast("long")).alias("id0"), F.xxhash64(F.col("id").isNull(), "text").alias("h"), "id", "text")
    keys = src.select("id", "id0", "h", F.char_length("text").cast("long").alias("n")).groupBy("id", "id0", "h").agg(F.max("n").alias("n"), F.count("*").alias("copies"))
    keys = cut(_neighbours(cut(keys)))
    one = src.select("id0", "h", "text").dropDuplicates(["id0", "h"])

    # what the row before needs of a document: its first code points and its signatures
    wanted = keys.select(F.col("next_id0").alias("id0"), F.col("next_h").alias("h"), F.col("id0").alias("to_id0"), F.col("h").alias("to_h"), F.floor(F.col("n") / share).cast("int").alias("take"))
    sent = one.join(wanted, ["id0", "h"]).select(F.col("to_id0").alias("id0"), F.col("to_h").alias("h"), F.substring(F.col("text"), F.lit(1), F.col("take")).alias("start"),
                                                 F.unhex(fingerprint(signatures(F.col("text"), chain))).alias("next_sigs"))
    rows = one.join(keys.select("id", "id0", "h", "n", "copies"), ["id0", "h"]).join(sent, ["id0", "h"])
    rows = rows.withColumn("next_sigs", F.regexp_extract_all(F.lower(F.hex("next_sigs")), F.lit(f"(.{{{_HEX}}})"), 1))

    take = F.floor(F.col("n") / share).cast("int")
    head = F.substring(F.col("text"), F.lit(1), (F.col("n") - take).cast("int"))
    # a copy is followed by a copy: its edit takes the start of its own text
    copied = F.when(F.col("copies") > 1, F.concat(head, F.substring(F.col("text"), F.lit(1), take)))
    rows = rows.select("id", "n", "copies", "text", F.concat(head, "start").alias("edited"), copied.alias("copied"), "next_sigs")
    rows = rows.select("id", "n", "copies", F.sha2("edited", 256).alias("sha"), F.sha2("copied", 256).alias("copied_sha"), signatures(F.col("text"), chain).alias("own"),
                       signatures(F.col("edited"), chain).alias("new"), F.when(F.col("copied").isNotNull(), signatures(F.col("copied"), chain)).alias("copied_sigs"), "next_sigs")
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    end = F.col("k") == 1
    out = rows.select("id", "n", "own", F.when(end, F.col("sha")).otherwise(F.col("copied_sha")).alias("sha"), F.when(end, F.col("new")).otherwise(F.col("copied_sigs")).alias("new"),
                      F.when(end, jaccard(F.col("own"), F.col("next_sigs"))).otherwise(F.lit(1.0)).alias("near_next"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"), fingerprint(F.col("own")).alias("fingerprint"),
                      fingerprint(F.col("new")).alias("edited_fingerprint"), jaccard(F.col("own"), F.col("new")).alias("near_edited"), "near_next")


def sql(chain: int = CHAIN, share: int = 3) -> str:
    """The query's rows in SQL."""
    anchors = ", ".join(f"'{a}'" for a in dict.fromkeys(ANCHORS))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
  coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS following FROM documents WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT *, substring(text, 1, n - n // {share}) || substring(following, 1, n // {share}) AS edited FROM t),
all_texts AS (SELECT doc_id, 'own' AS kind, text AS x FROM e UNION ALL SELECT doc_id, 'new', edited FROM e UNION ALL SELECT doc_id, 'next', following FROM e),
split AS (SELECT doc_id, kind, regexp_extract_all(lower(x), '{WORDS}') AS w, [{anchors}] AS anchors FROM all_texts),
parted AS (SELECT *, list_filter(w, lambda x: NOT list_contains(anchors, x)) AS c, list_filter(range(1, len(w) + 1), lambda i: list_contains(anchors, w[i])) AS a FROM split),
chains AS (SELECT doc_id, kind, CASE WHEN len(w) = 0 THEN [] ELSE [' ' || array_to_string((CASE WHEN len(c) > 0 THEN c ELSE w END)[1:{chain}], ' ')] END
  || list_filter(list_transform(a, lambda i, k: CASE WHEN i - k < len(c) THEN w[i] || ' ' || array_to_string(c[i - k + 1:i - k + {chain}], ' ') END), lambda s: s IS NOT NULL) AS found FROM parted),
sets AS (SELECT doc_id, kind, list_sort(list_distinct(list_transform(found, lambda s: md5(s)[1:{_HEX}]))) AS sigs FROM chains),
wide AS (SELECT doc_id, any_value(sigs) FILTER (kind = 'own') AS own, any_value(sigs) FILTER (kind = 'new') AS new, any_value(sigs) FILTER (kind = 'next') AS nxt FROM sets GROUP BY doc_id),
likeness AS (SELECT *, len(list_intersect(own, new)) AS i1, len(list_intersect(own, nxt)) AS i2 FROM wide)
SELECT e.doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(own, '') AS fingerprint, array_to_string(new, '') AS edited_fingerprint,
  CASE WHEN len(own) + len(new) = 0 THEN 1.0::DOUBLE ELSE i1::DOUBLE / (len(own) + len(new) - i1) END AS near_edited,
  CASE WHEN len(own) + len(nxt) = 0 THEN 1.0::DOUBLE ELSE i2::DOUBLE / (len(own) + len(nxt) - i2) END AS near_next
FROM e JOIN likeness l ON e.doc_id = l.doc_id"""
