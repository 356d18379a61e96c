"""Main text of web pages, with the host's template removed.

Two passes over the pages, both parsing the whole HTML once:
1. block elements' subtrees are hashed (their source with white space evened out); Spark counts in
   how many different pages of a host each hash occurs. Rows of a host with the same HTML (repeats,
   variants of a URL) are one page;
2. subtrees whose hash recurs in at least ``min_pages`` different pages are deleted, then the main
   text is what is left of the article.

Templates are joined by (host, hash), so no list grows with a host: a page gets only those of its own
subtrees that are template and can change its text. Nothing inside ``main`` is taken for template, and
inside an ``article`` only elements with loose text alone are: paragraphs, headings and other text
blocks and all that holds one stay, so an article that a host shows on many pages keeps its text.

What is never main text is also known by its element (navigation, page header, footer, aside, form,
script ...), its role or a class or id that names such a part as a whole (advert, sidebar, cookie-notice,
comments ...). The main text is that of the ``article`` elements, else of ``main``, else of the whole body.

Defined cases: null or empty HTML gives an empty text; text without any tag is one block; repeated
rows give the same text; a page without a host shares the empty host; unclosed and wrongly nested
elements are closed as browsers do in the common cases; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, prepared, written

MIN_PAGES = 10

# element names and words (fixed values)
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary
table tbody tfoot thead tr ul caption title""".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption summary address hgroup tr tbody thead tfoot caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
NEVER_TEXT = frozenset("""head script style noscript template iframe textarea title nav footer aside form button select svg
dialog menu search noembed noframes datalist""".split())
NEVER_ROLE = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NEVER_WORD = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion sidebar
menu nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices banner popup modal
newsletter subscribe subscription signup login social share sharing related recommended recommendations comment comments
disqus replies respond widget widgets toolbar pagination pager skiplink""".split())
# words that only place or shape what a class names
NEUTRAL_WORD = frozenset("""area bar block bottom box button buttons center column container content fixed float global group holder
inner item items js left link links list main outer overlay page panel post posts primary region right row secondary section
site sticky top user wrap wrapper""".split())
KEPT = frozenset("html body main".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z0-9]+")


def _names_unwanted(token: str) -> bool:
    """Does a class or id as a whole name something that is not main text (``ad-box``, ``site-footer``)? One
    that says anything else besides (``notice-periods``, ``related-work``) does not."""
    words = _WORD.findall(token)
    return any(w in NEVER_WORD for w in words) and all(w in NEVER_WORD or w in NEUTRAL_WORD or w.isdigit() for w in words)


@lru_cache(maxsize=20_000)
def _unwanted(name: str, attributes: str) -> bool:
    """Is an element with these attributes never main text? The id of a text block is an anchor and
    tells nothing."""
    if name in NEVER_TEXT:
        return True
    if not attributes or name in KEPT:
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        value = value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key == "role" and value in NEVER_ROLE:
            return True
        if key == "class" or key == "id" and name not in TEXT_BLOCKS:
            if any(map(_names_unwanted, value.split())):
                return True
    return False


@lru_cache(maxsize=64)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I)


def subtree_hash(html: str, at: int, end: int, children: list[tuple[int, int, int]]) -> int:
    """Hash of an element's source in which every hashed child is stood for by its own hash, so deep
    nesting costs no more than the page's length."""
    parts = []
    for a, b, h in children:
        parts += [html[at:a], f" {h} "]
        at = b
    source = " ".join("".join([*parts, html[at:end]]).split())
    return int.from_bytes(hashlib.blake2b(source.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class _Open:
    __slots__ = ("name", "at", "out", "regions", "drop", "hashed", "block", "children")

    def __init__(self, name, at, out, regions, drop, hashed, block):
        self.name, self.at, self.out, self.regions = name, at, out, regions
        self.drop, self.hashed, self.block, self.children = drop, hashed, block, []


def parse(html: str, templates: frozenset | set | None = None, hashes: list | None = None,
          used: list | None = None) -> list[str]:
    """Blocks of main text. ``templates`` are subtree hashes to delete; ``hashes``, if given, gets
    the hashes of the page's subtrees that may be template, and ``used`` those of them whose deletion
    can change the page's text."""
    out: list = []                    # text pieces, None between blocks
    regions: list[tuple[str, list]] = []   # (article or main, its pieces)
    stack: list[_Open] = []
    inside = 0                        # open article elements
    in_main = 0                       # open main elements
    inner: list[int] = []             # hashes of subtrees inside an article
    need_hash = hashes is not None or bool(templates)

    def close(to: int, at: int) -> None:
        """Close the elements from number ``to`` on; the last one ends before position ``at``."""
        nonlocal inside, in_main
        while len(stack) > to:
            e = stack.pop()
            gone = e.drop
            if not e.hashed and stack and e.children:      # an inline element hands its children on
                stack[-1].children += e.children
            if need_hash and e.hashed:
                h = subtree_hash(html, e.at, at, e.children)
                if stack:
                    stack[-1].children.append((e.at, at, h))
                if hashes is not None:
                    hashes.append(h)
                    if inside:
                        inner.append(h)
                gone = gone or bool(templates) and h in templates
            if e.name == "article":
                inside -= 1
            elif e.name == "main":
                in_main -= 1
            if gone:
                del out[e.out:]
                del regions[e.regions:]
            elif e.name == "article" and inside == 0 or e.name == "main":
                regions.append((e.name, out[e.out:]))
            if e.block:
                out.append(None)

    upto, position, n = 0, 0, len(html)
    scan = _TOKEN.search
    while True:
        m = scan(html, position)
        if m is None:
            break
        begin, position = m.span()
        if begin > upto:
            out.append(html[upto:begin])
        upto = position
        name = m[2] or m[5]
        if name is None:
            continue                  # comment, doctype, stray closing mark
        name = name.lower()
        if m[1] or m[4]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    close(i + 1, begin)
                    close(i, position)
                    break
                if stack[i].name in ("article", "main", "body") and name not in ("article", "main", "body", "html"):
                    break             # an end tag does not reach beyond these
            continue
        if name == "br":
            out.append(" ")
            continue
        if name in ("td", "th"):
            out.append(" ")
        block = name in BLOCKS
        if block:
            # an open paragraph ends before a block; items and rows end before the next one
            for i in range(len(stack) - 1, -1, -1):
                e = stack[i].name
                if e == "p" or e == name and name in ("li", "dt", "dd", "tr", "option") or {e, name} == {"dt", "dd"}:
                    close(i, begin)
                    break
                if e in BLOCKS and not (name in ("li", "dt", "dd") and e == "p"):
                    break
            out.append(None)
        if name in VOID:
            continue
        attributes = (m[3] if m[2] else m[6]).strip()
        drop = _unwanted(name, attributes) or name == "header" and inside == 0
        if name in RAW:
            end = _raw_end(name).search(html, position)
            upto = position = end.end() if end else n
            continue                  # never main text
        if attributes.endswith("/") and not block:
            continue
        if name in ("article", "main"):
            for e in stack:           # what holds an article is not a template
                e.hashed = False
            if name == "article":
                inside += 1
            else:
                in_main += 1
        elif inside and name in TEXT_BLOCKS:
            for e in reversed(stack):     # nor is what holds an article's text block
                if e.block and not e.hashed and e.name not in ("html", "body", "head"):
                    break                 # its holders are known
                e.hashed = False
        hashed = (block and name not in ("html", "body", "head", "article", "main") and in_main == 0
                  and (inside == 0 or name not in TEXT_BLOCKS))
        stack.append(_Open(name, begin, len(out), len(regions), drop, hashed, block))
    if upto < n:
        out.append(html[upto:])
    close(0, n)
    for kind in ("article", "main"):
        found = [r for k, r in regions if k == kind]
        if found:
            out = [x for r in found for x in [*r, None]]
            if used is not None:
                used += inner
            break
    else:
        if used is not None:
            used += hashes or []
    blocks, run = [], []
    for piece in [*out, None]:
        if piece is not None:
            run.append(piece)
        elif run:
            text = "".join(run)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                blocks.append(text)
            run = []
    return blocks


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def digest_of(html: Column) -> Column:
    """Names a page's content among those of its host."""
    return F.xxhash64(html)


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """Written ``host, digest, hashes``: per different page the subtrees that recur on its host, as
    far as they can change the page's text. Pages without such a subtree have no row."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), digest_of(F.col(html_col)).alias("digest"), F.col(html_col).alias("html"))

    def run(batches):
        for batch in batches:
            for p in pieces(batch, "html"):
                found, changing = [], []
                for h in p.column("html").to_pylist():
                    mine: list[int] = []
                    used: list[int] = []
                    parse(h or "", None, mine, used)
                    found.append(sorted(set(mine)))
                    changing.append(sorted(set(used)))
                yield pa.RecordBatch.from_arrays(
                    [p.column("host"), p.column("digest"), pa.array(found, pa.list_(pa.int64())), pa.array(changing, pa.list_(pa.int64()))],
                    names=["host", "digest", "hashes", "used"])

    seen = prepared(rows).mapInArrow(run, "host string, digest long, hashes array<long>, used array<long>")
    seen = written(seen.dropDuplicates(["host", "digest"]), "html-pages")
    often = (seen.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= min_pages).select("host", "hash"))
    often = written(often, "html-counts")
    hits = (seen.select("host", "digest", F.explode("used").alias("hash")).join(often, ["host", "hash"])
            .groupBy("host", "digest").agg(F.sort_array(F.collect_list("hash")).alias("hashes")))
    return written(hits, "html-templates")


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", out_col: str = "text",
              min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` without ``html_col``, with the main text. The pages' template lists are a written
    table, so Spark broadcasts them when they are small and otherwise joins by host and digest,
    splitting a page with many copies."""
    known = templates(pages, url_col, html_col, min_pages)
    kept = [f for f in pages.schema.fields if f.name not in (html_col, out_col)]
    rows = pages.select(F.struct(*[F.col(f.name) for f in kept]).alias("_row"), F.col(html_col).alias("_html"),
                        host_of(F.col(url_col)).alias("host"), digest_of(F.col(html_col)).alias("digest"))
    rows = rows.join(known, ["host", "digest"], "left").select("_row", "_html", "hashes")

    def run(batches):
        for batch in batches:
            for p in pieces(batch, "_html"):
                texts = ["\n".join(parse(h or "", frozenset(t) if t else None))
                         for h, t in zip(p.column("_html").to_pylist(), p.column("hashes").to_pylist())]
                yield pa.RecordBatch.from_arrays([p.column("_row"), pa.array(texts, pa.string())], names=["_row", out_col])

    from pyspark.sql import types as T

    done = prepared(rows).mapInArrow(run, T.StructType([rows.schema["_row"], T.StructField(out_col, T.StringType())]))
    return done.select(*[F.col("_row")[f.name].alias(f.name) for f in kept], out_col)


def page_report(pages: DataFrame) -> DataFrame:
    out = main_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
