"""Main text of web pages: structure first, then runs of words that a host repeats.

A parser cuts a page into blocks and marks what structure tells: scripts, menus, headers,
footers, forms, adverts and the like are never text, and what stands in an ``article``
(or else ``main``) element is, but for what the host repeats.  The token streams of a host's pages are
laid out as suffixes, named by their first ``RUN`` words, and brought into one order over
the cluster; neighbours with equal beginnings tell how many pages share it, and words
covered by such beginnings are a run as long as the pages agree.

* Of text that structure leaves open, a run is boilerplate if another page of the host has it, in
  open blocks or in those that structure sets apart.
* Of articles, a run is boilerplate if ``PAGES`` different articles and half of all article pages of the host have it.
  An article that would lose half of its words is a near copy of others and stays whole.

Most words of articles repeat nowhere, so their suffixes are laid out only if they can count:
pages are parsed in chunks, and what half of a host's pages share, half of its pages share in some
chunk.  Beginnings that do go to all tasks (or no suffix is left out, if they are too many).
"""

from __future__ import annotations

from collections import Counter
from functools import partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm import textgrid
from cellwise.session import cut_lineage, ship_package

RUN = 8  # words that must repeat together
PAGES = 4  # different articles of a host that must have a run
CHUNK = 1 << 20  # words of articles judged together while parsing; changes cost, never results
MAX_BEGINS = 1 << 21  # beginnings sent to all tasks, 16 MB; with more, all suffixes are laid out

# Elements without text of the page, those that are not its main text, and those that end a block.
SILENT = set("script style noscript template head title iframe svg object canvas audio video".split())
APART = set("nav header footer aside form button select textarea dialog menu".split())
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
MARKS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer"
    " disqus footer header masthead menu nav navbar navigation newsletter notice notices pagination popup promo promotion related"
    " share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)


# Words that stand beside those of MARKS in the name of a part of a page, not of a text about it.
NEUTRAL = set(
    "archive area bar block body bottom box button buttons center column container content element first form frame global group holder icon"
    " icons inner item items js last layout left link links list main menu module outer page panel post posts primary region right"
    " section secondary site slot space sticky text title top unit wrap wrapper zone".split()
)


HARD = 1000  # wrappers that count so much are never those of a whole page


def _marked(value: str) -> bool:
    """Whether a class or id is a part of the page: a name of MARKS, other words only of NEUTRAL (``ad-slot``, not ``share-price``)."""
    for name in value.replace("_", "-").split():
        words = [w for w in name.split("-") if w and not w.isdigit()]
        if MARKS.intersection(words) and MARKS.union(NEUTRAL).issuperset(words):
            return True
    return False


def _apart(tag: str, attrs: list) -> int:
    """0 for an element of the text, 1 if only its name in class or id or a form sets it apart, else HARD."""
    level = 1 if tag == "form" else HARD if tag in APART else 0
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES - {"form"}):
            return HARD
        if name == "role" and value == "form" or name in ("class", "id") and _marked(value):
            level = max(level, 1)
    return level


def _is_other(attrs: list) -> bool:
    """Whether an article is a comment, a teaser or the like by its role, or by the first word of a name in its class or id.

    Later words (``has-sidebar``, ``tag-cookies``) tell what it has, not what it is.
    """
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
        if name in ("class", "id") and MARKS.intersection(x.replace("_", "-").split("-")[0] for x in value.split()):
            return True
    return False


class _Blocks(HTMLParser):
    """Blocks of a page in order: text, and whether it is article, main, open, or apart.

    An article or main ends the apart state of wrappers that may hold a whole page.  Such an
    article is ``held`` with the number of those wrappers; ``_article`` decides about it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []
        self.words: list[str] = []
        self.stack: list[tuple[str, str, int]] = []  # tag, what its text is, how far it is apart
        self.open_tags: Counter[str] = Counter()  # of the stack
        self.open_blocks: list[int] = []  # where the stack has tags of BLOCKS
        self.state = "open"
        self.level = 0

    def end_block(self):
        if self.words:
            text = " ".join("".join(self.words).split())
            if text:
                self.blocks.append((text, self.state))
            self.words = []

    def set_state(self):
        self.state, self.level = self.stack[-1][1:] if self.stack else ("open", 0)

    def pop_to(self, index: int):
        self.open_tags.subtract(t for t, _, _ in self.stack[index:])
        del self.stack[index:]
        while self.open_blocks and self.open_blocks[-1] >= index:
            self.open_blocks.pop()
        self.set_state()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_block()
            if self.open_blocks:  # a block ends an open paragraph, an item the item before
                open_tag = self.stack[self.open_blocks[-1]][0]
                if open_tag == "p" and tag != "br" or open_tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    self.pop_to(self.open_blocks[-1])
        if tag in VOID:
            return
        inside, level = self.state, self.level
        if inside == "silent" or tag in SILENT:
            state = "silent"
        elif tag in ("article", "main"):
            in_article = self.open_tags["article"] > 0
            if tag == "article" and _is_other(attrs) or inside == "apart" and (in_article or level >= HARD):
                state, level = "apart", HARD
            elif in_article:
                state = inside
            elif tag == "main" or inside != "apart":
                state, level = tag, 0
            else:
                state, level = f"held{level}", 0
        elif tag == "header" and inside not in ("open", "apart"):
            state = inside
        elif tag not in ("html", "body") and (own := _apart(tag, attrs)):
            state, level = "apart", level + own
        else:
            state = inside
        if state != inside:
            self.end_block()
        if tag in BLOCKS:
            self.open_blocks.append(len(self.stack))
        self.open_tags[tag] += 1
        self.stack.append((tag, state, level))
        self.state, self.level = state, level

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_block()
        if not self.open_tags[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if self.stack[i][1] != (self.stack[i - 1][1] if i else "open"):
                    self.end_block()
                self.pop_to(i)
                return

    def parse_html_declaration(self, i):
        """Sections such as ``<![if x]>``, ended or not, are comments; the base class refuses some."""
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def handle_data(self, data):
        if self.state != "silent":
            self.words.append(data)


def blocks_of(html: str) -> list[tuple[str, str]]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.end_block()
    return parser.blocks


def host_of(url: str) -> str:
    _, found, rest = url.partition("://")
    for mark in "/?#":
        rest = rest.partition(mark)[0]
    return rest.lower() if found else ""


def _article(blocks) -> list[str] | None:
    """Articles, or else main, or else the articles held by the fewest wrappers; null if structure doesn't tell.

    Held articles must have more words than main, or than the open text of a page without main:
    else they are teasers beside the text.
    """
    texts = [t for t, k in blocks if k == "article"]
    if texts:
        return texts
    main = [t for t, k in blocks if k == "main"]
    fewest = min((int(k[4:]) for _, k in blocks if k.startswith("held")), default=0)
    if fewest:
        held = [t for t, k in blocks if k == f"held{fewest}"]
        if sum(len(t.split(" ")) for t in held) > sum(len(t.split(" ")) for t in main or [t for t, k in blocks if k == "open"]):
            return held
    return main or None


def _pages(batches):
    """Rows as Python values, some hundred at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            yield part, part.column("url").to_pylist(), part.column("html").to_pylist()


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _page_key(url, html) -> int:
    return _hash(f"{url}\0{html}")


def _windows(texts: pa.Array, hosts: np.ndarray, run: int):
    """For runs of rows, each window of ``run`` words: hash with the host, row, number of its first word."""
    factors = textgrid.mix(np.arange(1, run + 1, dtype=np.uint64)) | np.uint64(1)
    for row, data, offsets in textgrid.blocks(texts):
        starts, ends, owner = textgrid.spans(data, offsets)
        n = len(starts) - run + 1
        if n < 1:
            continue
        words = textgrid.span_hash(data, starts, ends)
        total = np.zeros(n, np.uint64)
        for k in range(run):
            total += words[k : k + n] * factors[k]
        first = np.searchsorted(owner, owner[:n])
        whole = owner[:n] == owner[run - 1 :]
        own = owner[:n][whole] + row
        yield textgrid.mix(total[whole] ^ textgrid.mix(hosts[own].view(np.uint64))), own, (np.arange(n) - first)[whole]


def _first_in_row(begin: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether a window is the first with its hash in its row."""
    order = np.lexsort((row, begin))
    first = np.ones(len(begin), bool)
    first[order[1:]] = (begin[order[1:]] != begin[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    return first


class _Shared:
    """Beginnings that half of the article pages of a host have, in a chunk of pages of about ``CHUNK`` words."""

    def __init__(self, run: int):
        self.run, self.words, self.rows, self.parts, self.hosts = run, 0, 0, [], []

    def add(self, texts: list[str], hosts: np.ndarray):
        for begin, row, _ in _windows(pa.array(texts, pa.string()), hosts, self.run):
            first = _first_in_row(begin, row)
            self.parts.append((begin[first], (row[first] + self.rows).astype(np.int32)))
            self.words += len(begin)
        self.hosts.append(hosts)
        self.rows += len(texts)

    def end(self):
        """The chunk, which ends here: ``host, begin`` and twice the pages beyond half; the hosts."""
        hosts = np.concatenate([np.zeros(0, np.int64), *self.hosts])
        begin, row = (np.concatenate([np.zeros(0, t), *x]) for t, x in zip((np.uint64, np.int32), zip(*self.parts, strict=True) if self.parts else ((), ()), strict=True))
        names, pages = np.unique(hosts, return_counts=True)
        begin, at, count = np.unique(begin, return_index=True, return_counts=True)
        host = hosts[row[at]]
        beyond = 2 * count - pages[np.searchsorted(names, host)]
        half = beyond >= 0
        self.__init__(self.run)
        return (host[half], textgrid.as_long(begin[half]), beyond[half]), names


KINDS = {"kind": pa.string(), "page_id": None, "url": pa.string(), "page_key": pa.int64(), "host": pa.int64(), "text": pa.string(), "blocks": pa.list_(pa.string()), "begin": pa.int64(), "stream": pa.int64(), "at": pa.int32()}


def _rows(kind: str, n: int, ids, **columns) -> pa.RecordBatch:
    """Rows of one kind; the other columns are null."""
    given = {"kind": [kind] * n, **columns}
    return pa.record_batch({k: pa.array(given[k], t or ids) if k in given else pa.nulls(n, t or ids) for k, t in KINDS.items()})


def _parsed(run: int, batches):
    """Four kinds of rows from one parse of each page.

    page: its text if structure tells it, and its open blocks otherwise.
    suffix: a beginning in the open and apart streams, with the hash of its stream and its position, which counts words of
    open blocks and is null where it is not within open blocks of a page without an article.
    shared: a beginning that half of the article pages of a host have in a chunk, ``at`` is twice the pages beyond half.
    chunk: a host with article pages in a chunk.
    """
    shared, ids = _Shared(run), None

    def chunk():
        (host, begin, beyond), names = shared.end()
        yield _rows("shared", len(host), ids, host=host, begin=begin, at=beyond.astype(np.int32))
        yield _rows("chunk", len(names), ids, host=names)

    for part, urls, htmls in _pages(batches):
        n, ids = part.num_rows, part.column("page_id").type
        found = [blocks_of(h) if h else [] for h in htmls]
        articles = [_article(b) if h else [] for b, h in zip(found, htmls, strict=True)]
        texts = [None if t is None else " ".join(t) for t in articles]
        keys = [_page_key(u, h) for u, h in zip(urls, htmls, strict=True)]
        names = [host_of(u or "") for u in urls]
        hosts = np.array([_hash(x) for x in names], np.int64)
        opens = [[x for x, k in b if k == "open"] if t is None else None for b, t in zip(found, texts, strict=True)]
        yield _rows("page", n, ids, page_id=part.column("page_id"), url=part.column("url"), page_key=keys, host=hosts, text=texts, blocks=opens)
        told = [i for i, t in enumerate(texts) if t]
        shared.add([texts[i] for i in told], hosts[told])
        if shared.words > CHUNK:
            yield from chunk()
        begin, stream, page, own_host, at = [], [], [], [], []
        for name, host, blocks, text, key in zip(names, hosts.tolist(), found, texts, keys, strict=True):
            for kind in ("open", "apart"):
                words = [w for t, k in blocks if k == kind or kind == "apart" and text is None and k.startswith("held") for w in t.split(" ")]
                if len(words) < run:
                    continue
                own = _hash(" ".join(words))
                for i in range(len(words) - run + 1):
                    begin.append(_hash(f"{name}\0{' '.join(words[i : i + run])}"))
                    stream.append(own)
                    page.append(key)
                    own_host.append(host)
                    at.append(None if text is not None or kind == "apart" else i)
        yield _rows("suffix", len(begin), ids, page_key=page, host=own_host, begin=begin, stream=stream, at=at)
    if shared.rows:
        yield from chunk()


def _article_suffixes(run: int, known, batches):
    """Suffixes of articles with a known beginning (all, if ``known`` is null); ``first`` marks the first of a page with it."""
    for batch in batches:
        keys, hosts = (batch.column(c).to_numpy() for c in ("page_key", "host"))
        texts = batch.column("text")
        for begin, row, at in _windows(texts, hosts, run):
            if known is not None:
                hit = known.value[np.minimum(np.searchsorted(known.value, begin), len(known.value) - 1)] == begin
                begin, row, at = begin[hit], row[hit], at[hit]
            streams = {i: _hash(texts[i].as_py()) for i in np.unique(row).tolist()}
            yield pa.record_batch({
                "host": hosts[row], "begin": textgrid.as_long(begin), "stream": pa.array([streams[i] for i in row.tolist()], pa.int64()),
                "page_key": keys[row], "at": pa.array(at, pa.int32()), "first": _first_in_row(begin, row),
            })


def _neighbours(batches):
    """Rows in the order of suffixes: of beginnings that neighbours share, how many streams and pages have them.

    Only the row before a batch is carried along.  A beginning at the edge of a batch or partition is given in parts.
    """
    before = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        host, begin, stream, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("host", "begin", "stream", "first"))
        new = np.ones(n, bool)
        new[1:] = (host[1:] != host[:-1]) | (begin[1:] != begin[:-1])
        other = new.copy()
        other[1:] |= stream[1:] != stream[:-1]
        if before is not None:
            other[0] = before != (host[0], begin[0], stream[0])
        before = (host[-1], begin[-1], stream[-1])
        at = np.flatnonzero(new)
        streams, pages = (np.add.reduceat(x.astype(np.int64), at) for x in (other, first))
        keep = streams > 1
        keep[[0, -1]] = True
        yield pa.record_batch({"host": host[at][keep], "begin": begin[at][keep], "streams": streams[keep], "pages": pages[keep]})


def shared_beginnings(suffixes: DataFrame) -> DataFrame:
    """``host, begin, streams, pages`` of the beginnings that neighbours in the order of suffixes share.

    The order goes by stream within a beginning, so one that a whole host has is spread over tasks.
    """
    order = ["host", "begin", "stream"]
    rows = suffixes.select(*order, "first").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = rows.mapInArrow(_neighbours, "host bigint, begin bigint, streams bigint, pages bigint")
    return parts.groupBy("host", "begin").agg(F.sum("streams").alias("streams"), F.sum("pages").alias("pages")).where("streams > 1")


def possible_beginnings(shared: DataFrame, chunks: DataFrame) -> DataFrame:
    """``host, begin`` of what half of a host's pages may have, from ``host, begin, at`` of the chunks where half have it, and ``host`` of all chunks.

    A chunk where fewer have it is short of half by half a page at least, so the chunks given must make up for all others.
    """
    own = shared.groupBy("host", "begin").agg(F.sum("at").alias("beyond"), F.count("*").alias("c"))
    of_host = chunks.groupBy("host").agg(F.count("*").alias("n_chunks"))
    return own.join(of_host, "host").where("beyond + c >= n_chunks").select("host", "begin")


def _article_runs(told: DataFrame, possible: DataFrame, run: int) -> DataFrame | None:
    """``page_key, at`` of beginnings in articles that enough articles of their host have; null if there are none."""
    spark = told.sparkSession
    hosts = told.where("text <> ''").groupBy("host").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= PAGES)
    known = possible.join(hosts, "host", "left_semi").select("begin").distinct().limit(MAX_BEGINS + 1).toArrow().column(0).to_numpy()
    if not len(known):
        return None
    sent = spark.sparkContext.broadcast(np.sort(known.astype(np.int64).view(np.uint64))) if len(known) <= MAX_BEGINS else None
    kinds = "host bigint, begin bigint, stream bigint, page_key bigint, at int, first boolean"
    suffixes = cut_lineage(told.select("page_key", "host", "text").mapInArrow(partial(_article_suffixes, run, sent), kinds))
    common = shared_beginnings(suffixes).join(hosts, "host").where(f"streams >= {PAGES} and 2 * pages >= n_pages")
    return suffixes.select("host", "begin", "page_key", "at").join(common.select("host", "begin").hint("merge"), ["host", "begin"]).select("page_key", "at")


def _unique_runs(run: int, batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for k, (blocks, spots) in enumerate(zip(batch.column("blocks").to_pylist(), batch.column("spots").to_pylist(), strict=True)):
            told = texts[k] is not None
            if told and not spots:
                continue
            words = [w for b in ([texts[k]] if told else blocks) for w in b.split(" ")]
            hit = np.zeros(len(words) + 1, np.int64)
            for i in set(spots or []):
                hit[i] += 1
                hit[i + run] -= 1
            covered = np.cumsum(hit)[:-1] > 0 if words else []
            if not told or 2 * np.count_nonzero(covered) < len(words):
                texts[k] = " ".join(w for w, c in zip(words, covered, strict=True) if not c)
        yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string())})


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row.

    Character references are decoded, white space in a block becomes one space, blocks
    are joined by one space in page order.  Null and empty pages have an empty text.  Copies
    of a page (equal streams of a host) count as one, so that a page is not boilerplate for
    being stored twice (of an article, its rows do count as pages of the host); repeated rows are
    judged alike; null ids and URLs are kept, and pages without a host share one.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    own = f"page_id {pages.schema[id_col].dataType.simpleString()}, url string"
    kinds = f"kind string, {own}, page_key bigint, host bigint, text string, blocks array<string>, begin bigint, stream bigint, at int"
    parsed = cut_lineage(rows.mapInArrow(partial(_parsed, run), kinds))
    found = parsed.where("kind = 'page'").select("page_id", "url", "page_key", "host", "text", "blocks")
    suffixes = parsed.where("kind = 'suffix'").select("host", "begin", "stream", "page_key", "at", F.lit(True).alias("first"))
    repeated = shared_beginnings(suffixes).select("host", "begin")
    covered = suffixes.where("at is not null").join(repeated.hint("merge"), ["host", "begin"]).select("page_key", "at")
    possible = possible_beginnings(parsed.where("kind = 'shared'").select("host", "begin", "at"), parsed.where("kind = 'chunk'").select("host"))
    in_articles = _article_runs(found.where("text is not null"), possible, run)
    if in_articles is not None:
        covered = covered.union(in_articles)
    # written first: its size tells whether the pages must be dealt for it
    spots = cut_lineage(covered.distinct().groupBy("page_key").agg(F.collect_list("at").alias("spots")))
    judged = found.join(spots, "page_key", "left").select("page_id", "url", "text", "blocks", "spots")
    both = judged.mapInArrow(partial(_unique_runs, run), f"{own}, text string")
    return both.withColumn("n_chars", F.length("text").cast("bigint"))
