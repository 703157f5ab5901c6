"""Embeddings against brute force, pages against written results, the pipeline's contract."""

import os

import numpy as np
import pytest

from newsweave.llm import embedding_dedup, html_text


def brute_links(vecs, least):
    unit = np.array([v / np.linalg.norm(v) for v in vecs])
    return [(i, j) for i in range(len(unit)) for j in range(len(unit)) if i != j and unit[i] @ unit[j] >= least]


def test_hadamard_is_orthogonal():
    h = embedding_dedup.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, 16 * np.eye(16))


def test_embedding_links(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 64))
    vecs = [c + rng.normal(size=64) * s for c in centres for s in (0.0, 0.05, 0.15, 0.25, 0.3)] + [3 * centres[0], centres[1]]
    vecs = [np.float32(v).astype(float) for v in vecs]
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vecs)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 64, 1), (n + 3, [None] + [1.0] * 63, 1), (n + 4, [float("nan")] * 64, 1), (n + 5, [float("inf")] * 64, 1), (None, rows[0][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    want = brute_links(vecs, 0.9)
    for block in (1024, 4):
        got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, 0.9, block=block).collect() if r.vec_id is not None}
        found = sum(got[i].n_links for i in range(n))
        assert 0.9 * len(want) <= found <= len(want)
        degree = np.bincount([i for i, _ in want], minlength=n)
        assert all(got[i].n_links <= degree[i] for i in range(n))
        assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(n, n + 6))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a>Menu</a></ul></nav><div class="ad-box">Buy</div><div id="cookie-notice">We use cookies</div>
<article><header><h1>Head &amp; line</h1><span>By me</span></header><p><b>One&nbsp;two<br>three <p>Four
 <i>five</i>six</p><div class="share">Tweet</div><aside>Side</aside><form><p>Sign up</form><ul><li>a<li>b</ul><!-- no --></article>
<section class="comments"><p>First!</p></section><footer>&copy; x</footer></body></html>"""


def test_blocks_of_a_page():
    got = [t for k, t in html_text.blocks_of(PAGE) if k == html_text.CONTENT]
    assert got == ["Head & line", "One two three", "Four fivesix", "a", "b"]


@pytest.mark.parametrize("wrapper", ['<div class="has-sidebar">', '<div class="no-sidebar">', '<div class="content side-left">', '<div id="login-required">',
                                     '<div class="sidebar">', '<form action="/">', '<header class="banner">'])
def test_wrappers_do_not_hide_the_page(wrapper):
    end = f"</{wrapper[1:].split()[0]}>"
    page = f"{wrapper}<nav>Menu</nav><article><p>Text</p><div class='share-buttons'>Tweet</div></article><section class='comments'><article>First!</article></section>{end}"
    got = html_text.blocks_of(page)
    assert [t for k, t in got if k == html_text.CONTENT] == ["Text"]
    assert [t for k, t in got if k == html_text.FURNITURE] == ["Menu", "Tweet", "First!"]


@pytest.mark.parametrize("wrapper", ['<div class="has-sidebar">', '<div class="no-sidebar">', '<div class="content side-left">', '<div class="login-required">', "<form>"])
def test_wrappers_without_an_article(wrapper):
    assert html_text.blocks_of(f"{wrapper}<p>Text</p><div class='ad-box'>Buy</div>") == [(html_text.UNDECIDED, "Text"), (html_text.FURNITURE, "Buy")]


def test_suffix_ranks_equal_brute_force():
    t = np.random.default_rng(1).integers(0, 3, 200).astype(np.uint64)
    for run in (1, 2, 5, 8):
        r = html_text.suffix_ranks(t, run)
        key = [tuple(t[i:i + run].tolist()) for i in range(len(t))]
        assert all((key[i] == key[j]) == (r[i] == r[j]) for i in range(len(t)) for j in range(len(t)))


@pytest.mark.parametrize("part_tokens", [5, 200_000])
def test_host_boilerplate(spark, part_tokens):
    bar = "Read our daily letter and never miss a thing"
    rows = [(i, f"http://h.example/{i}", f"<div>{bar}</div><div>unique text of page {i} goes on and on here</div>") for i in range(6)]
    rows += [(7, "http://other.example/", f"<p>{bar}</p>"), (8, None, None), (9, "x", ""), (10, "http://h.example/a", f"<article><p>{bar}</p></article>"),
             (11, "http://o2.example/", "<p>once only here on this host page"), (11, "http://o2.example/", "<p>once only here on this host page")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(df, run=6, part_tokens=part_tokens).collect()}
    assert all(got[i].text == f"unique text of page {i} goes on and on here" for i in range(6))
    assert got[7].text == bar and got[8].text == got[9].text == "" and got[10].text == bar and got[11].n_chars == len("once only here on this host page")
    assert html_text.extract(df.limit(0)).count() == 0


def test_undecided_blocks_beside_an_article(spark):
    bar = "Read our daily letter and never miss a thing"
    rows = [(i, f"http://h.example/{i}", f"<div>{bar}</div><div>lead of page {i} before it</div><article><p>teaser {i}</p></article><div>second part {i} after it</div>") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all(r.text == f"lead of page {r.page_id} before it\n\nteaser {r.page_id}\n\nsecond part {r.page_id} after it" for r in html_text.extract(df).collect())


@pytest.mark.parametrize("part_tokens", [5, 200_000])
def test_copies_and_shared_phrases_stay(spark, part_tokens):
    """Copies of a page, pages that share a text and phrases inside sentences are content."""
    long = "this long report about rivers and bridges is told only once here"
    rows = [(i, "http://copy.example/", f"<div>{long}</div>") for i in range(4)]
    rows += [(10 + i, "http://copy.example/", f"<nav>menu {i}</nav><div>{long}</div>") for i in range(4)]
    rows += [(20 + i, "http://two.example/", f"<div>{long}</div><div>note {i}</div>") for i in range(2)]
    rows += [(30 + i, None, f"<div>w{i} as a matter of fact we have seen x{i}</div><div>Home</div>" + (f"<div>{long}</div>" if i < 4 else "")) for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df, part_tokens=part_tokens).collect()}
    assert all(got[i] == got[10 + i] == long for i in range(4))
    assert all(got[20 + i] == f"{long}\n\nnote {i}" for i in range(2))
    # the one block that most pages have goes, though it is shorter than a run
    assert all(got[30 + i] == f"w{i} as a matter of fact we have seen x{i}" + (f"\n\n{long}" if i < 4 else "") for i in range(10))


def test_pipeline_stages(spark, tmp_path, odd, none):
    import corpus_pipeline as C
    from newsweave.llm.common import table
    assert [n for n, _ in C.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "substring dedup", "packing"]
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    extra = docs.limit(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "CAST(NULL AS BIGINT) AS n_chars")
    for start in (docs.unionByName(extra), docs.limit(0)):
        at = start
        for k, (_, stage) in enumerate(C.STAGES):
            out = stage(spark, at, sf)
            if k < 4:
                assert out.columns == docs.columns
            path = os.path.join(str(tmp_path), f"{id(start)}-{k}")
            out.write.parquet(path)
            at = spark.read.parquet(path)
    assert at.count() == 0


@pytest.mark.parametrize("inside", ["<script>x()</script>", "<svg><text>x</text></svg>", "<select><option>x</select>", "<style>x</style>", "<noscript>x</noscript>", "<iframe>x</iframe>", "<button>x</button>"])
def test_inline_skipped_elements_keep_the_text_around(inside):
    assert html_text.blocks_of(f"<article><p>One {inside}two</p></article>") == [(html_text.CONTENT, "One two")]


@pytest.mark.parametrize("start", ["<html><head><title>x</title>", "<head><meta charset=utf-8><title>x</title><link rel=a>", "<head><script>a</script>"])
def test_a_head_without_its_end(start):
    assert html_text.blocks_of(f"{start}<body><article><p>Text</p></article>") == [(html_text.CONTENT, "Text")]
    assert html_text.blocks_of(f"{start}<article><p>Text</p></article>") == [(html_text.CONTENT, "Text")]


@pytest.mark.parametrize("tag", ["video", "audio", "object", "iframe", "canvas", "button"])
def test_media_without_its_end_hide_nothing(tag):
    assert [t for _, t in html_text.blocks_of(f"<article><p>One</p><{tag} src=x><p>Two</p></article>")] == ["One", "Two"]
    assert [t for _, t in html_text.blocks_of(f"<article><p>One</p><{tag}><p>no</p></{tag}><p>Two</p></article>")] == ["One", "Two"]


def test_vectors_of_many_lengths(spark):
    rng = np.random.default_rng(3)
    rows = []
    for dim in range(1, 81):
        v = rng.normal(size=dim)
        rows += [(2 * dim, [float(x) for x in v]), (2 * dim + 1, [float(x) for x in v * 3 + 0.01 * abs(v).max() * rng.normal(size=dim)])]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9).collect()}
    assert all(got[2 * d].n_links == got[2 * d + 1].n_links == 1 and got[2 * d + 1].component_id == 2 * d for d in range(1, 81))
