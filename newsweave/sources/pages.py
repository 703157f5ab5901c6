"""SRC-4..SRC-6 re-aimed at a table of raw pages (page_id, url, html): article fields, listing
links in document order and the image candidate, found by selectors (``elements``).

Pages are parsed in Arrow batches, one page at a time, and only found strings leave the task;
all rules on these strings are native expressions. Which selectors are used is configuration.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.functions import text as TX
from newsweave.schemas import require_columns
from newsweave.sources.elements import Page, Selector


class Field(NamedTuple):
    """One field of a page: the text (or an attribute) of the first element that matches."""
    name: str
    selector: str
    attribute: str | None = None
    separator: str = ""
    required: bool = False


# Where an article page has its fields, where a listing page has its links, and
# where a page has its image: attributes of the main image tag tried in order (attribute names
# of a parsed page are lower case, so the second is never there), then its srcset attributes,
# then the two meta tags.
ARTICLE_FIELDS = (Field("title", "h2.media_end_head_headline", required=True),
                  Field("press", "a.media_end_head_top_logo img", "alt", required=True),
                  Field("publish_date", "span.media_end_head_info_datestamp_time", required=True),
                  Field("datetime_sort", "span.media_end_head_info_datestamp_time", "data-date-time", required=True),
                  Field("news_summary", "div._SUMMARY_CONTENT_BODY", separator=" "))
LISTING_CONTAINER = 'div.section_article._TEMPLATE[data-template-id="SECTION_ARTICLE_LIST"]'
LISTING_LINK = "a.sa_text_title"
IMAGE_TAG = "img#img1, div#img1 img"
IMAGE_ATTRS = ["src", "currentSrc", "data-src", "data-lazysrc", "data-origin-src"]
SRCSET_ATTRS = ["srcset", "data-srcset"]
IMAGE_METAS = ['meta[property="og:image"]', 'meta[name="twitter:image"]']
# Pages whose findings are held at once; a batch of Spark may have ten thousand.
PAGES_AT_ONCE = 64


def _parsed(pages: DataFrame, columns: list[str], fn: Callable[[Page], list], kind: str, out: str) -> DataFrame:
    """``columns`` of ``pages`` and, as column ``out``, what ``fn`` finds in each page."""
    rest = [c for c in columns if c != "html"]
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in rest) + f", {out} {kind}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"array<string>": pa.list_(pa.string()), "array<struct<href:string,text:string>>": pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))}
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                b = batch.slice(at, PAGES_AT_ONCE)
                found = [fn(Page(h.as_py())) for h in b.column("html")]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], pa.array(found, kinds[kind])], [*rest, out])
    return pages.select(*rest, "html").mapInArrow(run, schema)


def page_fields(pages: DataFrame, fields: tuple[Field, ...] = ARTICLE_FIELDS) -> DataFrame:
    """SRC-4: (page_id, url, a column per field) of pages that have an element for every required
    field. A field is null where its element or attribute is not there."""
    require_columns(pages, ["page_id", "url", "html"], "page_fields")
    rules = [(f, Selector(f.selector)) for f in fields]

    def find(page: Page) -> list[str | None]:
        values, there = [], []
        for f, selector in rules:
            e = next(iter(page.select(selector)), None)
            there.append(f.required <= (e is not None))
            values.append(None if e is None else page.text(e, f.separator) if f.attribute is None else e.attrs.get(f.attribute))
        return [*values, "" if all(there) else None]
    got = _parsed(pages, ["page_id", "url"], find, "array<string>", "found")
    got = got.where(F.get("found", F.lit(len(fields))).isNotNull())
    return got.select("page_id", "url", *[F.get("found", F.lit(i)).alias(f.name) for i, f in enumerate(fields)])


def article_rows(pages: DataFrame, fields: tuple[Field, ...] = ARTICLE_FIELDS) -> DataFrame:
    """Raw articles (title, press, news_summary, publish_date, datetime_sort, news_link, pos) of
    article pages: brackets removed from title and summary, a missing summary is empty."""
    f = page_fields(pages, fields)
    return f.select(TX.remove_brackets("title").alias("title"), "press", F.coalesce(TX.remove_brackets("news_summary"), F.lit("")).alias("news_summary"),
                    "publish_date", "datetime_sort", F.col("url").alias("news_link"), F.col("page_id").alias("pos"))


def listing_links(pages: DataFrame, container: str | None = LISTING_CONTAINER, link: str = LISTING_LINK) -> DataFrame:
    """SRC-5: (page_id, idx, pos, news_link, text) of the links inside the containers of listing
    pages (anywhere, without a container), in document order; ``pos`` is the ordered pair of
    page_id and idx. Links without an address are left out."""
    require_columns(pages, ["page_id", "html"], "listing_links")
    outer, inner = container and Selector(container), Selector(link)

    def find(page: Page) -> list[dict]:
        links = page.select(inner)
        if outer is not None:
            links = [e for c in page.select(outer) for e in links if page.inside(e, c)]
        return [{"href": e.attrs["href"], "text": page.text(e)} for e in links if e.attrs.get("href")]
    got = _parsed(pages, ["page_id"], find, "array<struct<href:string,text:string>>", "found")
    x = got.select("page_id", F.posexplode("found").alias("idx", "l"))
    return x.select("page_id", "idx", F.struct("page_id", "idx").alias("pos"), F.col("l.href").alias("news_link"), F.col("l.text").alias("text"))


def page_image(pages: DataFrame) -> DataFrame:
    """SRC-6: (page_id, url, image_url): first non-empty attribute of the main image, last srcset
    entry, og:image, twitter:image; '//' gets 'https:'; anything not starting with 'http' is
    rejected."""
    require_columns(pages, ["page_id", "url", "html"], "page_image")
    main, metas = Selector(IMAGE_TAG), [Selector(m) for m in IMAGE_METAS]
    names = [*IMAGE_ATTRS, *SRCSET_ATTRS]

    def find(page: Page) -> list[str | None]:
        tag = next(iter(page.select(main)), None)
        attrs = tag.attrs if tag else {}
        firsts = [next(iter(page.select(m)), None) for m in metas]
        return [attrs.get(a) or None for a in names] + [(e.attrs.get("content") or None) if e else None for e in firsts]
    got = _parsed(pages, ["page_id", "url"], find, "array<string>", "found")
    at = [F.get("found", F.lit(i)) for i in range(len(names) + len(metas))]
    n = len(IMAGE_ATTRS)
    cand = F.coalesce(*at[:n], *[TX.last_of_srcset(c) for c in at[n:len(names)]], *at[len(names):])
    cand = F.when(cand.startswith("//"), F.concat(F.lit("https:"), cand)).otherwise(cand)
    return got.select("page_id", "url", F.when(cand.startswith("http"), cand).alias("image_url"))


def cluster_image(articles: DataFrame, images: DataFrame, summary: DataFrame,
                  cluster_col: str = "cluster_id", order_col: str = "pos") -> DataFrame:
    """A-11: per cluster without an image yet, the image of its first article (row order)
    that has one. images: (news_link, image_url)."""
    filled = summary.where(~TX.is_empty_image("image_url")).select(F.col("cluster_id").alias(cluster_col))
    todo = articles.join(filled, cluster_col, "left_anti")
    hits = todo.join(images.where(F.col("image_url").isNotNull()), "news_link")
    return hits.groupBy(cluster_col).agg(F.min_by("image_url", order_col).alias("url"))
