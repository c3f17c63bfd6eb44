"""Main text of web pages: page structure and a suffix table per host.

A page's visible text is read as blocks.  Scripts, styles, comments and markup are
never text; blocks in menus, headers, footers, sidebars, notices, adverts, forms or
reader comments (by element or by class, id or role) are chrome, also articles inside
them.  Blocks inside a ``main`` element, or on pages without one inside an ``article``,
are content.  Inside the content only clear words make chrome (adverts, comments);
a vague one (notice, search, related) puts a block in doubt.  What is left is open.
Inline chrome goes without cutting the block around it.

The token streams of everything outside the content are laid out as suffixes per
host, cut at ``MIN_TOKENS`` tokens: the suffixes that begin with the same tokens are
the neighbours of a suffix array, so a stretch of at least ``MIN_TOKENS`` tokens is
repeated exactly where such a group spans several pages.  The array is kept as a
distributed table (host, prefix, page, position) and not as one array in memory,
since one host may hold a third of all pages.  A group on at least ``min_pages``
pages and ``min_share`` of the host's pages is boilerplate; ``enough_pages`` pages are
enough however large the host is.

A repeated stretch counts only for blocks it does not cut: inside a block it must lie
whole in that block, and a block shorter than ``MIN_TOKENS`` must lie whole in it.  The
first words of a block are not boilerplate because the block before ends alike.

The text is the content blocks of a page that marks them and those in doubt that are
not boilerplate as a whole, otherwise the open blocks less the boilerplate they hold
(their unique runs).  Content without doubt is never cut by the table: passages that
several articles share are part of each article.

Edge cases: null html is the empty page; a null or odd url has the host ''; pages
without text give ''; unclosed elements end with their parent; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import byte_chunks, table
from affinity.llm.lm import hashes

MIN_TOKENS = 6
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)>?|[^<]+|<", re.S)
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "audio", "video", "math"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
CHROME = {"nav", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu", "head", "title",
          "label", "fieldset", "datalist", "option"}
APART = {"button", "select", "textarea", "label"}     # set apart from the words around them
BLOCKS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "thead", "tbody",
          "tfoot", "tr", "td", "th", "caption", "section", "article", "main", "header", "footer", "nav", "aside",
          "blockquote", "pre", "figure", "figcaption", "form", "fieldset", "address", "hr", "body", "html", "head",
          "title", "details", "summary", "hgroup", "center"}
CONTAINERS = BLOCKS - {"p", "li", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6"}
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
# Words of a class, id or role that are chrome anywhere, and those that are chrome outside
# the content only: an article may have a section about a search or a notice.
CLEAR = (r"ads?|adverts?|advertisement|advertising|adsense|sponsor(?:ed)?|cookies?|gdpr|navbar|nav|navigation"
         r"|breadcrumbs?|sidebar|share|sharing|newsletter|subscribe|signup|login|comments?|commentlist|respond"
         r"|pagination|pager|complementary|contentinfo")
VAGUE = (r"banner|promo(?:tion)?|consent|notices?|alert|menu|widget|related|recommended|social|subscription|popup|modal"
         r"|overlay|replies|reply|discussion|footer|masthead|toolbar|search")
HINT = re.compile(rf"(?:^|[\s_-])(?:({CLEAR})|{VAGUE})(?=$|[\s_-])", re.I)
WANTED = re.compile(r"class|id|role|hidden", re.I)
ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s]*))?")


def _marks(attrs: str) -> tuple[int, bool]:
    """(hint, main) by an element's attributes; hint: 0 none, 1 vague, 2 clear chrome, 3 hidden."""
    hint, main = 0, False
    if not WANTED.search(attrs):
        return hint, main
    for name, value in ATTRIBUTE.findall(attrs):
        v, name = value.strip("\"'"), name.lower()
        if name == "hidden" or (name == "aria-hidden" and v.lower() == "true"):
            hint = 3
        elif name == "role" and v.lower() == "main":
            main = True
        elif name == "role" and v.lower() == "search":
            hint = max(hint, 2)
        elif name in ("class", "id", "role"):
            for m in HINT.finditer(v):
                hint = max(hint, 2 if m.group(1) else 1)
    return hint, main


class _Open:
    """Open elements; every lookup is by name, so a page costs time linear in its tags."""

    def __init__(self):
        self.stack: list[tuple[str, str]] = []        # element, kind of the text in it
        self.where: dict[str, list[int]] = {}         # depths of the open elements of a name
        self.blocks: list[int] = []                   # depths of blocks, and of containers
        self.containers: list[int] = []

    @property
    def kind(self) -> str:
        return self.stack[-1][1] if self.stack else "open"

    def push(self, name: str, kind: str):
        depth = len(self.stack)
        self.stack.append((name, kind))
        self.where.setdefault(name, []).append(depth)
        if name in BLOCKS:
            self.blocks.append(depth)
        if name in CONTAINERS:
            self.containers.append(depth)

    def close(self, depth: int):
        while len(self.stack) > depth:
            self.where[self.stack.pop()[0]].pop()
        for at in (self.blocks, self.containers):
            while at and at[-1] >= depth:
                at.pop()

    def last(self, names) -> int:
        return max((self.where[n][-1] for n in names if self.where.get(n)), default=-1)

    def end(self, name: str):
        """An end tag; that of an inline element ends no block around the tag."""
        depth = self.last((name,))
        if depth >= 0 and (name in BLOCKS or not self.blocks or self.blocks[-1] < depth):
            self.close(depth)

    def begin_block(self, name: str):
        """A block ends an open paragraph, and an item the item before it."""
        floor = self.containers[-1] if self.containers else -1
        for names in (ITEMS.get(name, ()), ("p",)):
            depth = self.last(names)
            if depth > floor:
                self.close(depth)
                break


def _kind_inside(name: str, outer: str, hint: int, main: bool) -> str:
    """Kind of the text in an element, by the kind around it.  In hidden elements all is
    gone; of chrome only ``main`` comes back (a wrapper may be named after a sidebar), of
    a form also an article (some sites put whole pages into one)."""
    if outer == "gone" or hint == 3:
        return "gone"
    if main:
        return "main"
    if name in CHROME:
        return "form" if name == "form" and outer != "chrome" else "chrome"
    if hint == 2 or outer == "chrome":
        return "chrome"
    if outer == "form":
        return "article" if name == "article" and not hint else "form"
    if outer != "open":
        return f"doubt {outer}" if hint and not outer.startswith("doubt") else outer
    if hint or name == "header":
        return "chrome"
    return "article" if name == "article" else "open"


def _settled(blocks: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Final kinds: articles beside a ``main`` element are no content."""
    content = "main" if any(k.endswith("main") for k, _ in blocks) else "article"
    final = {content: "content", f"doubt {content}": "doubt", "form": "chrome", "gone": "chrome", "chrome": "chrome"}
    return [(final.get(k, "open"), t) for k, t in blocks]


def page_blocks(page: str) -> list[tuple[str, str]]:
    """(kind, text) of all visible blocks in page order; kind: content, doubt (in the
    content, by a vague word), chrome, open.  Inline chrome is a block of its own and
    does not cut the block around it."""
    out: list[tuple[str, str]] = []
    tree = _Open()
    buffers: dict[str, list[str]] = {}

    def flush():
        for kind, parts in buffers.items():
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((kind, text))
        buffers.clear()

    pos, end = 0, len(page)
    while pos < end:
        m = TOKEN.match(page, pos)
        pos = m.end()
        name = m.group(2)
        if name is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                buffers.setdefault(tree.kind, []).append(m.group(0))
            continue
        name = name.lower()
        if m.group(1):
            if name in BLOCKS:
                flush()
            tree.end(name)
            continue
        if name in RAW:
            if not m.group(0).rstrip(">").endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, pos)
                pos = stop.end() if stop else end
            continue
        if name == "br" or name in APART:
            buffers.setdefault(tree.kind, []).append(" ")
        if name in BLOCKS:
            flush()
            tree.begin_block(name)
        if name in VOID:
            continue
        hint, role_main = _marks(m.group(3)) if m.group(3) else (0, False)
        if name in ("body", "html"):
            hint = 0
        tree.push(name, _kind_inside(name, tree.kind, hint, role_main or name == "main"))
    flush()
    return _settled(out)


def outside_tokens(blocks) -> list[bytes]:
    return [w for kind, text in blocks if kind != "content" for w in text.encode("utf-8", "surrogatepass").split()]


def prefixes(tokens: list[list[bytes]]):
    """(hash of the first MIN_TOKENS tokens of every suffix long enough, page, position);
    a shorter stream is one suffix."""
    flat = [w for t in tokens for w in t]
    lens = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    enc = pa.array(flat, pa.binary()).dictionary_encode()
    h = hashes(enc.dictionary.to_pylist())[enc.indices.to_numpy(zero_copy_only=False)]
    own = np.repeat(np.arange(len(tokens)), lens)
    pos = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    roll = np.zeros(len(flat), dtype=np.uint64)
    left = lens[own] - pos
    for k in range(MIN_TOKENS):
        part = np.zeros(len(flat), dtype=np.uint64)
        part[:max(len(flat) - k, 0)] = h[k:]
        inside = left > k
        roll = np.where(inside, (roll ^ part) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1), roll)
        roll ^= roll >> np.uint64(31)
    keep = (left >= MIN_TOKENS) | (pos == 0)
    return roll[keep].view(np.int64), own[keep], pos[keep]


def _suffixes(batches):
    for batch in batches:
        pages = [p or "" for p in batch.column("html").to_pylist()]
        for s, e in byte_chunks(pages):
            h, own, pos = prefixes([outside_tokens(page_blocks(p)) for p in pages[s:e]])
            take = pa.array(own + s)
            yield pa.RecordBatch.from_arrays(
                [batch.column("host").take(take), batch.column("page").take(take), pa.array(h),
                 pa.array(pos, pa.int32())], ["host", "page", "prefix", "pos"])


def main_text(blocks, covered: set[int]) -> tuple[str, int]:
    """Text of a page and how many tokens of boilerplate lie outside its content;
    ``covered``: positions at which a boilerplate suffix begins."""
    lens = np.array([len(t.encode("utf-8", "surrogatepass").split()) for k, t in blocks if k != "content"], dtype=np.int64)
    hit = np.zeros(lens.sum(), dtype=bool)
    ends = np.cumsum(lens)
    starts = ends - lens
    for p in covered:
        stop = min(p + MIN_TOKENS, len(hit))
        b = int(np.searchsorted(ends, p, side="right"))
        if stop <= ends[b]:                           # inside one block
            hit[p:stop] = True
            continue
        b += starts[b] < p
        while b < len(ends) and ends[b] <= stop:      # blocks the stretch holds whole
            hit[starts[b]:ends[b]] = True
            b += 1
    marked = any(k in ("content", "doubt") for k, _ in blocks)
    kept, at = [], 0
    for kind, text in blocks:
        if kind == "content":
            kept.append(text)
            continue
        words = text.encode("utf-8", "surrogatepass").split()
        here, at = hit[at:at + len(words)], at + len(words)
        if kind == "doubt":
            if not here.all():
                kept.append(text)
        elif kind == "open" and not marked:
            if not here.any():
                kept.append(text)
            elif not here.all():
                kept.append(b" ".join(w for w, x in zip(words, here) if not x).decode("utf-8", "surrogatepass"))
    return "\n".join(kept), int(hit.sum())


def _extract(batches):
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        pages = [unpack(p).decode("utf-8", "surrogatepass") for p in batch.column("packed").to_pylist()]
        found = [main_text(page_blocks(p), set(c or ())) for p, c in zip(pages, batch.column("covered").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array([t for t, _ in found], pa.string()),
             pa.array([len(t) for t, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())],
            ["page_id", "url", "text", "n_chars", "n_boilerplate"])


def _pack(batches):
    """Pages compressed for the shuffle that brings their boilerplate."""
    pack = zstandard.ZstdCompressor(level=6).compress
    for batch in batches:
        packed = [pack((p or "").encode("utf-8", "surrogatepass")) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("page"), batch.column("url"), pa.array(packed, pa.binary())],
            ["page_id", "page", "url", "packed"])


def extract_main(pages: DataFrame, min_pages: int = 3, min_share: float = 0.1,
                 enough_pages: int = 100) -> DataFrame:
    """(page_id, url, text, n_chars, n_boilerplate) of every page row."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.col("html").cast("string").alias("html"))
    # A page row is known by a hash of its columns; equal rows share their boilerplate.
    p = (p.withColumn("page", F.xxhash64("page_id", "url", "html"))
          .withColumn("host", F.xxhash64(F.regexp_extract(
              F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))))
    suffix = p.select("host", "page", "html").mapInArrow(_suffixes, "host long, page long, prefix long, pos int")
    host_pages = p.groupBy("host").agg(F.countDistinct("page").alias("pages"))
    repeated = (suffix.select("host", "prefix", "page").distinct()
                      .groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
                      .join(host_pages, "host")
                      .where(F.col("n") >= F.least(min_share * F.col("pages"), F.lit(float(enough_pages)))).select("host", "prefix"))
    covered = (suffix.join(repeated, ["host", "prefix"])
                     .groupBy(F.col("page").alias("_p")).agg(F.collect_set("pos").alias("covered")))
    packed = p.select("page_id", "page", "url", "html").mapInArrow(
        _pack, "page_id long, page long, url string, packed binary")
    whole = packed.join(covered, F.col("page") == F.col("_p"), "left")
    return (whole.select("page_id", "url", "packed", "covered")
                 .mapInArrow(_extract, "page_id long, url string, text string, n_chars long, n_boilerplate long"))


def query(spark, sf_dir: str) -> DataFrame:
    return extract_main(table(spark, sf_dir, "pages"))
