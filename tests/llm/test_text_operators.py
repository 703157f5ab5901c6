"""Operators on texts against brute force, the public libraries and exact round trips."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsweave.llm import bpe, common, language_id, line_quality, ngram_join, packing, quality_rules, substring_dedup, token_counts

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
REF = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aaeinorst -\n\t'1　\u0085é漢😀́", max_size=80))
def test_bpe_equals_tiktoken(text):
    ids = np.frombuffer(bpe.encoder(RANKS, P.PATTERN).encode(text), "<u4")
    assert ids.tolist() == REF.encode_ordinary(text)
    assert bpe.decode_ids(ids.tobytes(), RANKS) == text.encode()


def test_bpe_survives_a_small_state_table():
    fst = bpe.Transducer(bpe.load_ranks(RANKS), max_states=50)
    for word in ("internationalisation", "aaaaaaaaaaaaaaaaaaaaa", "xyzzyqwv" * 9):
        assert fst.encode(word.encode()) == REF.encode_ordinary(word)


def test_decoder_holds_back_unfinished_code_points():
    by_id = {v: k for k, v in bpe.load_ranks(RANKS).items()}
    single = {v: k for k, v in by_id.items() if len(v) == 1}
    ids = np.array([single[bytes((b,))] for b in "é漢😀".encode()], np.uint32)
    done, rest = bpe.decoder(RANKS).decode(ids[:-1])
    assert [x.decode() for x in done if x] == ["é", "漢"] and rest == "😀".encode()[:3]


def test_round_trip_query(odd, none):
    rows = bpe.round_trip(odd, RANKS, P.PATTERN).collect()
    texts = [r.text or "" for r in odd.collect()]
    assert sorted((r.n_tokens, r.decoded_sha256) for r in rows) == sorted((len(REF.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for t in texts)
    assert bpe.round_trip(none, RANKS, P.PATTERN).count() == 0


def test_token_counts(spark, odd, none):
    n = [len(REF.encode_ordinary(r.text or "")) for r in odd.collect()]
    t = token_counts.limits(token_counts.length_histogram(bpe.count_documents(odd, RANKS, P.PATTERN, keep=[])))
    got = {r.n_tokens: r for r in t.collect()}
    assert set(got) == set(n)
    for x, r in got.items():
        assert (r.n_docs, r.docs_ge, r.tokens_ge) == (n.count(x), sum(y >= x for y in n), sum(y for y in n if y >= x))
        assert r.truncated_total == sum(min(x, y) for y in n) and r.fit_share == sum(y <= x for y in n) / len(n)
    assert token_counts.truncated(t, 100).first().tokens == sum(min(100, y) for y in n)
    assert token_counts.quantile(t, 0.5).first().n_tokens == sorted(n)[len(n) // 2 - 1]
    by = token_counts.limits(token_counts.length_histogram(bpe.count_documents(odd, RANKS, P.PATTERN, keep=["lang"]), ["lang"]), ["lang"])
    assert by.where("lang IS NULL").agg(F.sum("n_docs")).first()[0] == odd.where("lang IS NULL").count()
    assert token_counts.limits(token_counts.length_histogram(bpe.count_documents(none, RANKS, P.PATTERN, keep=[]))).count() == 0


def brute_components(docs, k, percent):
    sets = {}
    for d, text in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_ngram_join_equals_brute_force(spark):
    rnd = random.Random(5)
    base = [[f"v{rnd.randrange(400)}" for _ in range(rnd.randint(1, 120))] for _ in range(12)]
    docs = []
    for d in range(150):
        w = list(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(50)}"
        docs.append((d, " ".join(w).upper() if d % 3 else "\n".join(w)))
    docs += [(200, None), (201, ""), (202, " "), (203, "a b"), (204, "A  B")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for k, percent, lead in ((4, 85, 1), (5, 80, 64)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df, k, percent, leaders=lead, class_part=7).collect()}
        assert got == brute_components(docs, k, percent)


def test_ngram_join_of_borderline_copies_equals_brute_force(spark):
    """A third of the rows are edits of one text, most pairs of which are just below or above
    the threshold, others share a passage only; ``leaders`` leave many of them to the matrix."""
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(110)]
    docs = []
    for d in range(240):
        if d % 3:
            w = [f"u{rnd.randrange(10**6)}" for _ in range(rnd.randint(5, 60))] + (base[20:40] if d % 3 == 1 else [])
        else:
            w = base[:rnd.choice((90, 100, 110))]
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = f"z{rnd.randrange(10**6)}"
        docs.append((d, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_components(docs, 4, 85)
    groups = Counter(want[d][1] for d in range(0, 240, 3))
    assert len(groups) > 5 and max(groups.values()) > 5
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df, 4, 85, leaders=1, class_part=9, part_shingles=300).collect()}
    assert got == want


def test_ngram_join_reads_texts_in_bounds(spark):
    """Texts reach no Python worker to be dropped there, batches are looked at in pieces, and the
    memo of word hashes stays small; words are lower-cased with the text."""
    src = spark.createDataFrame([(i, f"Text {i}") for i in range(400)] + [(None, "none"), (-5, "Minus")], "doc_id long, text string")
    wanted = spark.createDataFrame([(-5, "a"), (7, "b"), (7, "c"), (399, "d"), (900, "e")], "rep long, low string")
    some = ngram_join._texts(src, wanted)
    assert "MapInArrow" not in some._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.rep, r.low, r.text) for r in some.collect()) == [(-5, "a", "Minus"), (7, "b", "Text 7"), (7, "c", "Text 7"), (399, "d", "Text 399")]
    batch = pa.RecordBatch.from_pydict({"x": list(range(1000))})
    pieces = list(ngram_join._pieces(iter([batch, batch.slice(0, 0)])))
    assert max(b.num_rows for b in pieces) < 1000 and [x for b in pieces for x in b.column(0).to_pylist()] == list(range(1000))
    assert common._WORD_HASH.limit <= 100_000
    assert ngram_join.shingles("Ärger\u00a0X AB\x0bcD\tE f", 2).tolist() == ngram_join.shingles("Ärger\u00a0x ab cd e F", 2).tolist()


def test_ngram_join_parities_bound_what_is_not_shared():
    """The bound holds for sets of different sizes, and tells near copies from others."""
    rnd = np.random.default_rng(3)
    for n, m, both in ((400, 380, 370), (400, 400, 200), (70, 60, 58), (1, 1, 0), (5000, 4100, 4000), (64, 65, 64)):
        s = np.unique(rnd.integers(0, 1 << 63, n + m - both, dtype=np.uint64))
        a, b = np.sort(s[:n]), np.sort(s[n - both:])
        x, y = (np.frombuffer(ngram_join._parity(v), np.uint64) for v in (a, b))
        bound = ngram_join._apart(x, y)
        assert bound == ngram_join._apart(y, x) <= len(a) + len(b) - 2 * both
        if 100 * both >= 85 * len(s):
            assert ngram_join._close(len(a), len(b), bound, 85)
    s = rnd.integers(0, 1 << 63, 600, dtype=np.uint64)
    x, y = (np.frombuffer(ngram_join._parity(np.sort(v)), np.uint64) for v in (s[:400], s[200:]))
    assert not ngram_join._close(400, 400, ngram_join._apart(x, y), 85)


def test_ngram_join_shared_shingles_equal_brute_force(spark):
    rnd = random.Random(9)
    rows = sorted({(sig, 20 + 3 * sig, rnd.randrange(9), t) for sig in range(40) for t in rnd.sample(range(60), 6)})
    want = sorted(r for r in rows if any(o[3] == r[3] and o[0] != r[0] and 100 * min(o[1], r[1]) >= 85 * max(o[1], r[1]) for o in rows))
    df = spark.createDataFrame(rows + rows[::3], "sig long, n long, pos int, token long")
    assert 0 < len(want) < len(rows)
    assert sorted(map(tuple, ngram_join._shared(df, 85).select("sig", "n", "pos", "token").collect())) == want


def test_ngram_join_makes_one_link_for_a_query_and_part(spark):
    """The members of a part are connected: one link of a query tells as much as all of them, and
    their number does not grow with the product of members and queries."""
    texts = {i: " ".join(f"b{j}" if j != 7 * i else f"z{i}" for j in range(300)) for i in range(12)} | {12: "none of these words here"}
    rows = [(5, 0, int(i >= 6), i, ngram_join._signature(ngram_join.shingles(t, 4)), t) for i, t in texts.items()]
    df = spark.createDataFrame(rows + rows[:2], "g long, part int, kind int, rep long, sig long, text string")
    got = sorted(map(tuple, ngram_join._verified(df, 4, 85).collect()))
    assert [u for u, _ in got] == list(range(6, 12)) and all(v < 6 for _, v in got)


def test_ngram_join_odd_rows(odd, none):
    got = ngram_join.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    home = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert home[2] == 1 and home[8] == 7 and home[10] == 9 and home[4] == 4 and home[3] == 3
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert ngram_join.near_duplicates(none).count() == 0


def brute_spans(texts, width):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if count[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_substring_dedup_equals_brute_force(spark, odd, none):
    rnd = random.Random(3)
    shared = [" ".join(f"p{k}q{i}" for i in range(20)) for k in range(5)]
    rows = []
    for d in range(80):
        parts = [rnd.choice(shared) if rnd.random() < 0.4 else " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.randint(0, 15))) for _ in range(5)]
        rows.append((d, "\n".join(parts)))
    rows += [(100, "r s t u " * 10), (101, None), (102, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = {d: w for (d, _), w in zip(rows, brute_spans([t for _, t in rows], 12))}
    for chunk in (40, 400_000):
        spans = substring_dedup.repeated_spans(substring_dedup.keyed(df), 12, chunk_windows=chunk)
        found = {(r.k1, r.k2): bytes(r.spans) for r in spans.collect()}
        for r in substring_dedup.keyed(df).collect():
            n, gone, kept = substring_dedup.cut_words(r.text, found.get((r.k1, r.k2)))
            assert (n, gone, kept.decode()) == want[r.doc_id]
    got = substring_dedup.remove(odd, 12)
    assert got.columns == odd.columns and got.count() == odd.count()
    assert got.where("doc_id = 3").first().text is None and got.where("doc_id = 2").first().text == ""
    assert substring_dedup.digests(odd).count() == odd.count() and substring_dedup.digests(none).count() == 0


@pytest.mark.parametrize("lengths", [[], [1], [0, 5, 4096, 4097, 12288], list(range(1, 300)), [4095] * 7 + [1, 2]])
def test_packing_fills_sequences(lengths):
    parts = packing.pack_lengths(lengths, 4096, 1.0, 1 / 4096)
    seen, filled = defaultdict(list), defaultdict(list)
    for d, at, n, s, o in parts:
        seen[d].append((at, n))
        filled[s].append((o, n))
    for where, total in ((seen, dict(enumerate(lengths))), (filled, None)):
        for key, v in where.items():
            v.sort()
            assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:]))
            end = sum(v[-1])
            assert end == total[key] if total else end == 4096 or end & (end - 1) == 0
    assert sum(p[2] for p in parts) == sum(lengths)


def test_packing_costs_are_balanced():
    parts = packing.pack_lengths([2000, 1500, 1000, 500] * 50, 4096, 1.0, 1 / 4096)
    cost = defaultdict(float)
    for _, _, n, s, _ in parts:
        cost[s] += n + n * n / 4096
    full = sorted(cost.values())[5:]
    assert full[-1] < 1.35 * full[0]


def test_packing_keeps_every_id(odd, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    odd = odd.unionByName(odd.sparkSession.createDataFrame([(40 + i, t) for i, t in enumerate(("a<|endoftext|>b c", "<|STARTOFTEXT|> <|startoftext|>", "<|endoftext|", "½x é\u0301"))], "doc_id long, text string"), allowMissingColumns=True)
    got = packing.pack(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), WORDS, 2, group_tokens=500).collect()
    ids = defaultdict(bytes)
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert r.start * 4 == len(ids[r.doc_id]) and r.length * 4 == len(r.ids)
        ids[r.doc_id] += bytes(r.ids)
    for r in odd.where("doc_id IS NOT NULL").collect():
        assert np.frombuffer(ids[r.doc_id], "<u4").tolist() == [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]
    assert packing.pack(none, WORDS, 2).count() == 0


def test_quality_statistics_equal_brute_force(odd, none):
    for r, s in zip(odd.collect(), quality_rules.statistics(odd).collect()):
        w = WORD.findall(r.text or "")
        c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        assert (s.n_words, s.word_chars, s.n_repeat_words, s.n_dup_lines) == (len(w), sum(map(len, w)), len(hit), len(lines) - len(set(lines)))
    assert quality_rules.judge(none).count() == 0


def test_quality_rejects_outliers(spark):
    rnd = random.Random(2)
    rows = []
    for d in range(400):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(40, 300))]
        rows.append((d, " ".join(w + "%%%" for w in words) if d % 50 == 0 else " ".join(words), "en" if d % 2 else None, "s" if d % 3 else None))
    got = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {d for d, k in got.items() if not k} == set(range(0, 400, 50))


@pytest.mark.parametrize("kind", quality_rules.DIMS)
def test_quality_rejects_an_outlier_of_each_statistic(spark, kind):
    rnd = random.Random(5)

    def text(d):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(80, 200))]
        if d % 50:
            return " ".join(words)
        if kind == "x_word":
            return " ".join(w * 4 for w in words)
        if kind == "x_symbol":
            return " ".join(w + "%%%" for w in words)
        if kind == "x_line":  # three lines in four are copies, but all windows of eight words differ
            return "\n".join(x for w in words for x in (w, "abc hgfe", "bad cafe", "egg head"))
        return " ".join(words[:80] + words[:11])  # 22 of 91 words

    rows = [(d, text(d), "en", "s") for d in range(400)]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == set(range(0, 400, 50))


def test_language_id_held_out(spark, odd, none):
    sounds = {"aa": "ka to mi re sol ", "bb": "sch ung ein der lich ", "cc": "qué ción los mente "}
    rnd = random.Random(1)
    rows = [(d, " ".join("".join(rnd.choices(sounds[k].split(), k=rnd.randint(1, 3))) for _ in range(rnd.randint(3, 200))), k) for d, k in enumerate(list(sounds) * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    content = language_id.train(df.where(~language_id.held_out()))
    got = language_id.classify(df, content).where(language_id.held_out()).collect()
    assert got and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    back = language_id.classify(odd, content)
    assert [c for c in back.columns if c == "score"] == ["score"] and back.count() == odd.count()
    assert {r.lang_pred for r in back.where("doc_id IN (3, 4, 5)").collect()} == {"und"} and back.where("doc_id = 3 AND accepted").count() == 0
    assert language_id.train(none) == {} and language_id.classify(none, content).count() == 0


def test_language_id_rejects_unclear_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang").where("lang <> 'es'")
    content = language_id.train(docs.where(~language_id.held_out()))
    rnd = random.Random(3)
    held = [r for r in docs.where(language_id.held_out()).collect() if r.text and len(language_id.letters(r.text)) >= 200]
    by = {k: [language_id.letters(r.text) for r in held if r.lang == k] for k in ("de", "en")}
    rows = [(r.text, "clean") for r in held]
    rows += [(f"{a[:300]} {b[:300]}", "mixed") for a, b in zip(by["de"], by["en"]) if len(a) >= 300 and len(b) >= 300]
    rows += [(" ".join("".join(rnd.choices("bcdfghjklmnpqrstvwxz", k=rnd.randint(3, 9))) for _ in range(n)), "noise") for n in (10, 20, 60) for _ in range(20)]
    rows += [(" ".join("".join(rnd.choices(("ką", "ž", "ių", "dė", "gy", "ška", "pū"), k=rnd.randint(1, 3))) for _ in range(n)), "unlearned") for n in (10, 20, 60) for _ in range(20)]
    got = Counter((r.kind, r.accepted) for r in language_id.classify(spark.createDataFrame(rows, "text string, kind string"), content).collect())
    assert got["clean", True] >= 0.95 * (got["clean", True] + got["clean", False])
    for kind, part in (("mixed", 0.85), ("noise", 1.0), ("unlearned", 1.0)):
        assert got[kind, False] >= part * (got[kind, True] + got[kind, False]) > 0, got


def test_line_crf(spark, odd, none):
    scores, trans = np.random.default_rng(0).normal(size=(6, 2)), np.random.default_rng(1).normal(size=(2, 2))
    import itertools
    total, node, edge = 0.0, np.zeros((6, 2)), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=6):
        p = np.exp(sum(scores[i, a] for i, a in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
        total += p
        for i, a in enumerate(y):
            node[i, a] += p
        for a, b in zip(y, y[1:]):
            edge[a, b] += p
    got = line_quality.marginals(scores, trans)
    assert np.allclose(got[0], node / total) and np.allclose(got[1], edge / total) and np.isclose(got[2], np.log(total))
    rnd = random.Random(4)
    rows = []
    for d in range(120):
        lines = [" ".join(rnd.choice(("some", "plain", "words", "here")) + str(rnd.randrange(9)) for _ in range(9)) for _ in range(rnd.randint(1, 6))]
        rows.append((d, "\n".join(x.upper().replace(" ", "!! ") if d % 4 == 0 else x for x in lines), int(d % 4 != 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = line_quality.train(df.drop("quality"), df.where(~language_id.held_out()))
    held = line_quality.classify(df, model).where(language_id.held_out()).collect()
    assert held and all(r.predicted == r.quality for r in held)
    assert line_quality.classify(odd, model).where("score BETWEEN 0 AND 1").count() == odd.count()
    assert line_quality.classify(none, model).count() == 0


@pytest.mark.parametrize("text", ["½ ²", "①②", "\u0301", "12 34", "!?", "", None])
def test_texts_without_letters_have_no_language(text):
    judge = language_id.Classifier({"en": b"the and of to in", "de": b"der die das und"})
    assert judge.predict(text)[:2] == ("und", 0.0) and judge.predict("the ½ and")[0] == "en"


def test_quality_rules_of_odd_rows(odd, none):
    clashing = odd.withColumnsRenamed({"score": "d2", "rep": "kept", "k1": "grp"})
    got = quality_rules.judge(clashing).collect()
    assert len(got) == odd.count() and all(r.kept is False for r in got if r.base_failed) and all(r.grp == "z" for r in got)
    assert quality_rules.judge(none).count() == 0


def test_other_tokenizers_get_whole_texts(tmp_path):
    """A tokenizer that keeps white space or splits otherwise is not sent words."""
    from tokenizers import Tokenizer, models, pre_tokenizers
    tok = Tokenizer(models.BPE(vocab={c: i for i, c in enumerate(" ab")}, merges=[]))
    tok.pre_tokenizer = pre_tokenizers.Sequence([])
    tok.save(str(tmp_path / "t.json"))
    enc = packing.WordEncoder(str(tmp_path / "t.json"), 2)
    assert np.frombuffer(enc.encode("a b  a"), "<u4").tolist() == [*tok.encode("a b  a").ids, 2]
