"""Operator 10: main text of web pages with a suffix array per host.

1. Each page is parsed once into blocks of text. Blocks inside an article (or main) element are
   content; blocks inside navigation, headers, footers, sidebars, adverts, notices, comment
   sections and forms of an article are furniture; all others are undecided. Class names mark
   layout as often as furniture, so an article (or main) inside a marked element is content
   again, but for comment sections, lists of related pages and elements that are furniture by
   their tag or role.
2. The tokens of a host's furniture and undecided blocks are concatenated and sorted as a
   suffix array. Runs of ``run`` tokens inside a block (a shorter block counts as one run) are
   boilerplate when they occur in at least ``least`` distinct bodies of the host and in at least
   the share ``share`` of them; undecided blocks that such runs cover whole are removed. A body
   is the text of a page without furniture, so copies of a page count once.
3. What is left, content and unique runs, is joined in page order. Unique undecided blocks
   are kept on every page, also beside an article.

Article text is never removed for being repeated: copies of an article on other pages are
content, and deleting duplicates is the task of other operators. Phrases shared inside otherwise
unique blocks stay too. A host is split into parts of bounded size by body; a suffix's first
``run`` tokens are compared between the parts of a host by hash, so the split changes no result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, word_hashes

CONTENT, FURNITURE, UNDECIDED = 0, 1, 2
#: Of open elements only: furniture that no article inside it ends.
_HELD = 3

# Element names as HTML defines them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("script style noscript template head title svg math iframe object canvas audio video select textarea button datalist map".split())
_IN_HEAD = frozenset("html head base link meta noscript script style template title".split())
_END_TAG = re.compile(f"</({'|'.join(sorted(_SKIP))})(?=[\\s/>])", re.I)
_ASIDE = frozenset("nav footer aside dialog menu".split())
_FORM = frozenset("form fieldset".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_CLOSES_P = _BLOCK - {"body", "html", "tbody", "thead", "tfoot", "tr", "td", "th", "caption", "li", "dt", "dd"}
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLE = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: Whole class and id names that mark furniture: these words, also several of them joined, after
#: a word for the page and before one for a list or box; "has-sidebar" and "side-left" are none.
_OF_COMMENTS = "comments?|commentlist|disqus|respond|replies|reply"
_OF_OTHERS = "related|recommend(?:ed|ations?)?"
_WORDS = f"""ads?|advert(?:s|isement|ising)?|banner|sponsor(?:ed|s)?|promo(?:tion)?s?|nav(?:bar|igation)?|menu|breadcrumbs?
|sidebar|side|widgets?|footer|masthead|topbar|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|signup|login
|share|sharing|social|pagination|pager|skip|toolbar|tags|byline|{_OF_COMMENTS}|{_OF_OTHERS}""".replace("\n", "")
_NAME = r"(?:(?:site|page|main|top|bottom|global|primary|secondary|post|article|entry)[_-])?(?:{0})(?:[_-](?:{1}))*(?:[_-](?:box|bar|list|links?|buttons?|icons?|items?|slot|unit|posts?|articles?|stories|form|thread|body|meta))?(?:[_-]?[0-9]+)?"
_MARK = re.compile(_NAME.format(_WORDS, _WORDS), re.I)
_HOLDS = re.compile(_NAME.format(f"{_OF_COMMENTS}|{_OF_OTHERS}", _WORDS), re.I)


class _Reader(HTMLParser):
    """Blocks of one page as (kind, text); elements left open end with their parent."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str]] = []
        self.parts: list[str] = []
        # open elements: (name, kind of its text, or None if it is skipped)
        self.stack: list[tuple[str, int | None]] = [("", UNDECIDED)]
        self.ends: Counter[str] = Counter()

    def flush(self) -> None:
        if self.parts:
            kind = self.stack[-1][1]
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text and kind is not None:
                self.blocks.append((FURNITURE if kind == _HELD else kind, text))

    def close_to(self, at: int) -> None:
        while len(self.stack) > at:
            # text collected so far is of the block around a skipped element, which has none itself
            if self.stack[-1][0] in _BLOCK:
                self.flush()
            self.stack.pop()

    def kind_of(self, tag: str, attrs: dict) -> int | None:
        above = self.stack[-1][1]
        if above is None or tag in _SKIP or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return None
        if above == _HELD:
            return _HELD
        role = (attrs.get("role") or "").lower()
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split() if tag not in ("html", "body", "main") else ()
        if tag in _ASIDE or role in _ROLE or any(map(_HOLDS.fullmatch, names)):
            return _HELD
        if tag in ("article", "main") or role in ("main", "article") or "articlebody" in (attrs.get("itemprop") or "").lower():
            return CONTENT
        if tag == "header" or any(map(_MARK.fullmatch, names)):
            return FURNITURE
        # a form around a page holds all of it, one inside an article is furniture
        if tag in _FORM or role == "form":
            return FURNITURE if any(n == "article" for n, _ in self.stack) else UNDECIDED if above == CONTENT else above
        return above

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br" or tag == "wbr":
            self.parts.append(" " if tag == "br" else "")
            return
        if tag not in _IN_HEAD:  # the end tag of a head may be omitted
            self._end("head", stop=frozenset(("body",)))
        if tag in _SKIP and tag != "head" and not self.ends[tag]:
            return  # never closed: what follows is not inside
        if tag in _BLOCK:
            self.flush()
        if tag in _CLOSES_P:
            self._end("p", stop=_BLOCK - {"p"})
        if tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
            self._end(tag, stop=frozenset(("ul", "ol", "dl", "table", "select")) if tag != "td" and tag != "th" else frozenset(("tr", "table")))
        if tag in _VOID:
            return
        given = dict(attrs)
        in_article = any(k == CONTENT for _, k in self.stack)
        kind = self.kind_of(tag, given)
        if tag in _HEADING and kind == FURNITURE and in_article and self._only_header():
            kind = CONTENT
        self.stack.append((tag, kind))

    def _only_header(self) -> bool:
        """Whether the innermost furniture is a header inside the article."""
        for (name, kind), (_, above) in zip(self.stack[:0:-1], self.stack[-2::-1]):
            if kind == FURNITURE and above != FURNITURE:
                return name == "header" and above == CONTENT
        return False

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _end(self, tag: str, stop: frozenset) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at][0] == tag:
                self.close_to(at)
                return
            if self.stack[at][0] in stop:
                return

    def handle_endtag(self, tag: str) -> None:
        self.ends[tag] -= tag in _SKIP
        if tag in _BLOCK:
            self.flush()
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at][0] == tag:
                self.close_to(at)
                return

    def handle_data(self, data: str) -> None:
        if self.stack[-1][1] is not None:
            self.parts.append(data)


def blocks_of(html: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page in page order; none for null and empty pages."""
    if not html:
        return []
    r = _Reader()
    r.ends.update(t.lower() for t in _END_TAG.findall(html))
    r.feed(html)
    r.close()
    r.close_to(1)
    r.flush()
    return r.blocks


def suffix_ranks(tokens: np.ndarray, run: int) -> np.ndarray:
    """Rank of every suffix by its first ``run`` tokens (prefix doubling, the last step
    overlaps); suffixes of equal rank share these tokens."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < run:
        step = min(have, run - have)
        nxt = np.concatenate((rank[step:], np.full(step, -1, np.int64)))
        rank = np.unique((rank << np.int64(32)) | (nxt + 1), return_inverse=True)[1].astype(np.int64)
        have += step
    return rank


_PART = "host string, mark long, of long, bodies long, places binary, keys binary"
#: Fills blocks of fewer than ``run`` tokens.
_PAD = np.uint64(0x9E3779B97F4A7C15)


def padded(tokens: np.ndarray, counts: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of blocks of ``counts`` tokens, short blocks filled up to ``run``, and the length
    of every block."""
    wide = np.maximum(counts, run)
    out = np.full(wide.sum(), _PAD)
    out[np.repeat(np.cumsum(wide) - wide - np.cumsum(counts) + counts, counts) + np.arange(len(tokens))] = tokens
    return out, wide


def _repeated(streams: DataFrame, run: int, share: float, least: int) -> DataFrame:
    """(body_key, starts): places in the undecided blocks of a body (padded) where ``run``
    tokens start that are boilerplate of the host. ``streams`` has a row for each body; ``of``
    is the number of bodies of its host."""
    def part(t: pa.Table) -> pa.Table:
        """Classes of one part's suffix array: a hash of the shared tokens, the number of
        bodies, and the places in undecided blocks."""
        keys = t.column("body_key").to_numpy()
        blocks = [np.frombuffer(x, "<i4") for x in t.column("counts").to_pylist()]
        counts = np.concatenate(blocks).astype(np.int64)
        tokens, wide = padded(np.concatenate([np.frombuffer(x, np.uint64) for x in t.column("tokens").to_pylist()]), counts, run)
        owner = np.repeat(np.repeat(np.arange(len(keys)), [len(x) for x in blocks]), wide)
        place = np.arange(len(tokens)) - np.searchsorted(owner, owner)
        block = np.repeat(np.arange(len(wide)), wide)
        undecided = (np.arange(len(wide)) - np.repeat(np.cumsum([0, *map(len, blocks)])[:-1], [len(x) for x in blocks]) < np.repeat(t.column("open").to_numpy(), [len(x) for x in blocks]))[block]
        rank = suffix_ranks(tokens, run)
        # runs do not leave their block
        ok = np.flatnonzero(np.arange(len(tokens)) + run <= np.cumsum(wide)[block])
        order = ok[np.argsort(rank[ok], kind="stable")]  # the suffix array, whole runs only
        first = np.concatenate(([True], np.diff(rank[order]) != 0))
        edge = np.flatnonzero(first)
        mark = np.zeros(len(edge), np.uint64)
        for k in range(run):
            mark = mix(mark * np.uint64(31) + tokens[order[edge] + k])
        # a class is in page order, so each change of the owner is another body
        bodies = np.add.reduceat((first | (np.diff(owner[order], prepend=-1) != 0)).astype(np.int64), edge)
        held = undecided[order]
        ends = np.concatenate(([0], np.cumsum(held)))[np.concatenate((edge, [len(order)]))]
        places, key = place[order[held]].astype("<i4"), keys[owner[order[held]]].astype("<i8")
        return pa.table({"host": pa.array([t.column("host")[0].as_py()] * len(edge), pa.string()), "mark": pa.array(mark.view(np.int64)),
                         "of": pa.array([t.column("of")[0].as_py()] * len(edge), pa.int64()), "bodies": pa.array(bodies),
                         "places": pa.array([places[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                         "keys": pa.array([key[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())})

    classes = cut(streams.where(F.length("tokens") > 0).groupBy("host", "part").applyInArrow(lambda t: part(t), _PART))
    often = (classes.groupBy("host", "mark").agg(F.sum("bodies").alias("n"), F.max("of").alias("of"))
             .where((F.col("n") >= least) & (F.col("n") >= share * F.col("of"))).select("host", "mark"))
    hit = classes.where(F.length("places") > 0).join(often, ["host", "mark"], "left_semi").select("keys", "places")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = np.concatenate([np.frombuffer(x, "<i8") for x in b.column(0).to_pylist()])
                s = np.concatenate([np.frombuffer(x, "<i4") for x in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(s)], ["body_key", "start"])
    return hit.mapInArrow(spread, "body_key long, start int").groupBy("body_key").agg(F.sort_array(F.collect_set("start")).alias("starts"))


_PARSED = "page_id long, url string, page_key long, host string, kinds array<int>, texts array<string>, body_key long, counts binary, tokens binary, open int"


def extract(pages: DataFrame, run: int = 6, part_tokens: int = 200_000, share: float = 0.5, least: int = 3, by_tags: bool = True,
            id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A null or empty page, and one without main text, gives an empty text. Pages with a null
    url or one without host share the host ''. Repeated rows get equal results. A host of fewer
    than ``least`` bodies shows nothing to be boilerplate. With ``by_tags`` false all blocks are
    undecided, so the suffix array alone decides. Other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1))
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                       F.xxhash64(id_col, url_col, html_col).alias("page_key"), host.alias("host"), F.col(html_col).alias("html"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, texts, keys, counts, tokens, undecided = [], [], [], [], [], []
            for html, page_key, host in zip(b.column(4).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                blocks = blocks_of(html) if by_tags else [(UNDECIDED, x) for _, x in blocks_of(html)]
                # undecided blocks first, so that their places are the same in all pages of a body
                words = [[x.encode("utf-8", "surrogatepass").split() for k, x in blocks if k == kind] for kind in (UNDECIDED, FURNITURE)]
                kinds.append([k for k, _ in blocks])
                texts.append([x if k != FURNITURE else "" for k, x in blocks])
                body = "\0".join([host, *(f"{k}{x}" for k, x in blocks if k != FURNITURE)])
                keys.append(xxhash.xxh3_64_intdigest(body.encode("utf-8", "surrogatepass")) - (1 << 63) if blocks else page_key)
                counts.append(np.array([len(w) for part in words for w in part], "<i4").tobytes())
                tokens.append(word_hashes([x for part in words for w in part for x in w]).tobytes())
                undecided.append(len(words[0]))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(kinds, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string())), pa.array(keys, pa.int64()),
                                              pa.array(counts, pa.binary()), pa.array(tokens, pa.binary()), pa.array(undecided, pa.int32())],
                                             ["page_id", "url", "page_key", "host", "kinds", "texts", "body_key", "counts", "tokens", "open"])
    parsed = src.mapInArrow(parse, _PARSED)
    streams = (parsed.where(F.size("kinds") > 0).groupBy("host", "body_key").agg(F.min(F.struct("tokens", "counts", "open")).alias("s"))
               .select("host", "body_key", "s.*"))
    sizes = streams.groupBy("host").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.length("tokens") / 8) / part_tokens)).cast("int").alias("parts"), F.count("*").alias("of"))
    streams = streams.join(sizes, "host").withColumn("part", F.pmod(F.xxhash64("body_key", F.lit(5)), F.col("parts")).cast("int"))
    found = _repeated(streams, run, share, least)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for kinds, texts, starts in zip(*(c.to_pylist() for c in b.columns[2:])):
                at, keep = 0, []
                covered = np.zeros(sum(max(len(x.split()), run) for k, x in zip(kinds, texts) if k == UNDECIDED), bool) if starts else None
                for s in starts or ():
                    covered[s:s + run] = True
                for kind, text in zip(kinds, texts):
                    if kind == UNDECIDED and starts:
                        n = len(text.split())
                        if not covered[at:at + n].all():
                            keep.append(text)
                        at += max(n, run)
                    elif kind != FURNITURE:
                        keep.append(text)
                out.append("\n\n".join(keep))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(out, pa.string())], ["page_id", "url", "text"])
    # pages without undecided blocks have no places; a key of their own keeps copies from meeting in one task
    out = parsed.withColumn("body_key", F.when(F.col("open") > 0, F.col("body_key")).otherwise(F.col("page_key"))).join(found, "body_key", "left").select("page_id", "url", "kinds", "texts", "starts").mapInArrow(assemble, "page_id long, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
