"""Main text of web pages with removal of site templates.

Each page is parsed once, in time linear in its length, into the text blocks of
its main region (``main`` where most of its text stands outside articles, else
the articles, else ``main``, else the body) without menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments.  Names
of classes and ids mark furniture only as a whole, never on an element that
holds the article, and not where nothing else would be left.  Every
block carries the hashes of the element subtrees it stands in.  Spark counts,
per host, on how many different pages each subtree occurs; a subtree on at
least ten, and on twice the root of the number of a host's pages, is a template
and its blocks go: a section's template counts on a host of many sections.  Pages whose main text is the same count once, and a page of which nothing
would be left that way repeats others as a whole: it keeps its text.

Defined results: null, empty and tag-only pages give the empty text; pages
without a host have no templates; repeated rows give repeated results; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .store import ship, write_table

PER_ROOT, LEAST = 2.0, 10      # least pages of a template: per root of the host's pages, and at all
LEVELS = 64                    # elements around a block that may be its template

_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile("[>\"']")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
section summary table tbody tfoot thead tr ul""".split())
_DROP = frozenset("""nav footer aside form script style noscript template iframe svg math button select textarea head title
object embed canvas audio video menu dialog search""".split())
# Words of class and id names, and roles, that mark page furniture (fixed values).
_FURNITURE = frozenset("""ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promoted
promotion cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup menu
navbar nav navigation breadcrumb breadcrumbs sidebar aside widget widgets footer masthead comment comments commentlist disqus reply
replies respond share sharing social related recommended recommendations pagination pager login skip toolbar disclaimer alert
paywall outbrain taboola topbar sitemap""".split())
# Words that may stand beside them in one name (fixed values); any other word makes the name something else.
_BESIDE = frozenset("""area bar block blocks body bottom box button buttons container cta entry form global group holder icons inner item
items left link links list main media mobile module outer page panel post posts primary right row secondary section side site slot
sticky text top unit wrap wrapper""".split())
_HEADER = frozenset("header head masthead".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
# A start tag on the left closes an open element on the right up to the given bounds.
_CLOSES = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
           "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select", "datalist"))}
_FENCE = frozenset(("article", "main", "body", "html"))


KEPT, GONE, DOUBTFUL, HEADER = range(4)     # what an element's tag, role and names say about it


def _name_kind(name: str) -> int:
    """One class or id name as a whole: furniture if its words are, beside neutral ones."""
    words = {w.lower() for w in _WORDS.findall(name)}
    if not words <= _FURNITURE | _BESIDE | _HEADER:
        return KEPT
    return DOUBTFUL if words & _FURNITURE else HEADER if words & _HEADER else KEPT


def _kind(tag: str, attrs: str) -> tuple[int, str]:
    """What an element is, and its class names."""
    if not attrs or attrs.isspace():
        return GONE if tag in _DROP else KEPT, ""
    found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTR.findall(attrs)}
    if (tag in _DROP or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
            or found.get("role", "").lower() in _ROLES
            or "display:none" in found.get("style", "").replace(" ", "").lower()):
        return GONE, found.get("class", "")
    kinds = set() if tag in ("html", "body") else {_name_kind(n) for n in f"{found.get('class', '')} {found.get('id', '')}".split()}
    return DOUBTFUL if DOUBTFUL in kinds else HEADER if HEADER in kinds else KEPT, found.get("class", "")


class _Scanner:
    """Tags of a page, front to back, in time linear in its length whatever is left open."""

    def __init__(self, html: str):
        self.html, self.at = html, 0
        self.text_from = 0
        self._dead: set[int] = set()        # quotes from which no tag end was found outside quotes

    def _tag_end(self, at: int) -> int:
        """The ``>`` that ends a tag: the first outside quotes; the first at all where a quote stays open; -1 without one."""
        first = self.html.find(">", at)
        if first < 0:
            return -1
        seen, pos = [], at
        while m := _STOP.search(self.html, pos):
            if m[0] == ">":
                return m.start()
            if m.start() in self._dead:
                break
            seen.append(m.start())
            close = self.html.find(m[0], m.end())
            if close < 0:
                break
            pos = close + 1
        self._dead.update(seen)
        return first

    def __iter__(self) -> Iterator[tuple[str, str, str, bool]]:
        """Text before a tag, the tag's name (empty: markup without one), its attributes, whether it is an end tag."""
        html = self.html
        while (at := html.find("<", self.at)) >= 0:
            self.at = at + 1
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                end = len(html) if end < 0 else end + 3
                name, attrs = "", ""
            elif html.startswith("<![CDATA[", at):
                end = html.find("]]>", at + 9)
                end = len(html) if end < 0 else end + 3
                name, attrs = "", ""
            elif html.startswith(("<!", "<?"), at):
                end = html.find(">", at) + 1
                name, attrs = "", ""
            elif m := _NAME.match(html, at):
                close = self._tag_end(m.end())
                end = close + 1
                name, attrs = m[1], html[m.end():close]
            else:
                continue
            if not end:
                break                                     # no > from here on: the rest is text
            text = html[self.text_from:at]
            self.at = self.text_from = end
            yield text, name.lower(), attrs, html.startswith("</", at)

    def skip(self, end: re.Pattern) -> None:
        """Moves behind the next match, or to the end."""
        found = end.search(self.html, self.at)
        self.at = self.text_from = found.end() if found else len(self.html)

    def rest(self) -> str:
        return self.html[self.text_from:]


class Page:
    """Blocks of one page: texts, and the elements each stands in."""

    def __init__(self, html: str):
        self.tags, self.parents, self.kinds, self.hashes = ["#"], [0], [KEPT], [0]
        self.blocks: list[tuple[str, int]] = []          # text, innermost block element
        self._parts: list[list[str]] = [[]]
        self._open, self._text = [0], []
        self._depth: dict[str, int] = {}                 # open elements by tag
        scanner = _Scanner(html)
        for text, tag, attrs, is_end in scanner:
            if text:
                self._text.append(text)
            if not tag:
                continue
            if is_end:
                self._end(tag)
                continue
            self._start(tag, attrs)
            if tag in _RAW_END:
                scanner.skip(_RAW_END[tag])
                self._end(tag)
        if text := scanner.rest():
            self._text.append(text)
        while len(self._open) > 1:
            self._close()
        self._flush()

    def _flush(self) -> None:
        if self._text:
            if text := " ".join(unescape("".join(self._text)).split()):
                self.blocks.append((text, self._open[-1]))
                self._parts[self._open[-1]].append(text)
            self._text = []

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br" or tag in ("td", "th"):
            self._text.append(" ")
        if tag in _VOID:
            if tag == "hr":
                self._flush()
            return
        if tag in _BLOCK:
            self._flush()
            self._pop_to("p", _FENCE | {"table", "td", "button"})
        if tag in _FENCE:
            self._flush()
            for t in ("nav", "header", "aside", "footer", "ul", "ol"):
                self._pop_to(t, _FENCE)
        if tag in _CLOSES:
            for t in _CLOSES[tag][0].split():
                self._pop_to(t, _FENCE | set(_CLOSES[tag][1]))
        if tag not in _BLOCK and tag not in _DROP and not (attrs and "class" in attrs) and "hidden" not in attrs and "id=" not in attrs \
                and not self._depth.get(tag):
            return                                        # inline formatting makes no element of its own
        kind, names = _kind(tag, attrs)
        if kind in (GONE, DOUBTFUL) or tag in _BLOCK or self._depth.get(tag):
            if self._breaks(kind, tag):
                self._flush()
            self.tags.append(tag)
            self.parents.append(self._open[-1])
            self.kinds.append(kind)
            self._depth[tag] = self._depth.get(tag, 0) + 1
            self.hashes.append(0)
            self._parts.append([tag, names])
            self._open.append(len(self.tags) - 1)

    @staticmethod
    def _breaks(kind: int, tag: str) -> bool:
        """Whether an element ends the block around it; a script inside a paragraph doesn't."""
        return tag in _BLOCK or kind in (GONE, DOUBTFUL) and tag not in _RAW_END

    def _close(self) -> None:
        node = self._open[-1]
        if self._breaks(self.kinds[node], self.tags[node]):
            self._flush()
        self._open.pop()
        self._depth[self.tags[node]] -= 1
        self.hashes[node] = xxhash.xxh64_intdigest("\x01".join(self._parts[node])) - (1 << 63)
        self._parts[self._open[-1]].append(str(self.hashes[node]))

    def _pop_to(self, tag: str, fence) -> None:
        """Close the nearest open ``tag`` that no element of ``fence`` shields."""
        if not self._depth.get(tag):
            return
        for i in range(len(self._open) - 1, 0, -1):
            if self.tags[self._open[i]] == tag:
                while len(self._open) > i:
                    self._close()
                return
            if self.tags[self._open[i]] in fence:
                return

    def _end(self, tag: str) -> None:
        if tag in ("td", "th"):
            self._text.append(" ")
        self._pop_to(tag, _FENCE - {tag} if tag not in ("body", "html") else ())

    def _below(self, own: list, add) -> list:
        """A value of every element from its parent's and its own; parents come first."""
        out = [own[0]]
        for node in range(1, len(self.tags)):
            out.append(add(out[self.parents[node]], own[node]))
        return out

    def _holds_main(self) -> list[bool]:
        """Elements with an ``article`` or ``main`` that has text below them (or that are one)."""
        text = [0] * len(self.tags)
        for words, node in self.blocks:
            text[node] += len(words)
        holds = [t in ("article", "main") for t in self.tags]
        for node in range(len(self.tags) - 1, 0, -1):
            text[self.parents[node]] += text[node]
        for node in range(len(self.tags) - 1, 0, -1):
            holds[node] = holds[node] and text[node] > 0
            holds[self.parents[node]] = holds[self.parents[node]] or holds[node]
        return holds

    def main(self) -> tuple[list[str], list[list[int]]]:
        """Texts of the main region's blocks, and for each the hashes of its elements inside the region."""
        found = self._main(True)
        return found if found[0] else self._main(False)      # names alone don't empty a page

    def _main(self, by_name: bool) -> tuple[list[str], list[list[int]]]:
        holds = self._holds_main()
        drops = [k == GONE and t != "form" or by_name and k == DOUBTFUL and not h for k, t, h in zip(self.kinds, self.tags, holds)]
        gone = self._below(drops, lambda a, b: a or b)
        forms = self._below([int(t == "form") for t in self.tags], int.__add__)
        headers = self._below([int(t == "header") for t in self.tags], int.__add__)
        named = self._below([int(k == HEADER) for k in self.kinds], int.__add__)
        inside = {tag: self._below([n if t == tag else 0 for n, t in enumerate(self.tags)], lambda a, b: a or b) for tag in ("article", "main", "body")}

        def region(root: str) -> list[tuple[str, int, int]]:
            """Text, element and root element (the outermost such) of the region's blocks."""
            out = []
            for text, node in self.blocks:
                top = inside[root][node] if root != "#" else 0
                if gone[node] or root != "#" and not top or forms[node] > forms[top]:
                    continue
                # a header of the page goes, a heading in an article's own header stays
                heading = root in ("article", "main") and self.tags[node][0] == "h" and self.tags[node][1:].isdigit()
                if headers[node] > headers[top] and not heading or root in ("body", "#") and named[node] > named[top]:
                    continue
                out.append((text, node, top))
            return out

        regions = {root: region(root) for root in ("article", "main")}
        own = sum(len(text) for text, node, _ in regions["main"] if not inside["article"][node])
        teasers = sum(len(text) for text, node, _ in regions["main"] if inside["article"][node])
        order = ("main", "article") if own > teasers else ("article", "main")
        for root in (*order, "body", "#"):
            if kept := regions[root] if root in regions else region(root):
                return [text for text, _, _ in kept], [self._chain(node, top) for _, node, top in kept]
        return [], []

    def _chain(self, node: int, top: int) -> list[int]:
        """Hashes of the elements from a block outwards, inside the region, up to ``LEVELS`` of them."""
        out = []
        while node and node != top and len(out) < LEVELS:
            out.append(self.hashes[node])
            node = self.parents[node]
        return out


_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("sig", pa.int64()),
                     ("texts", pa.list_(pa.string())), ("hashes", pa.list_(pa.list_(pa.int64())))])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [Page(h or "").main() for h in batch["html"].to_pylist()]
        sig = [xxhash.xxh64_intdigest("\n".join(t)) - (1 << 63) for t, _ in out]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"].cast(pa.int64()), batch["url"], batch["host"], pa.array(sig, pa.int64()),
             pa.array([t for t, _ in out], _PARSED.field("texts").type),
             pa.array([h for _, h in out], _PARSED.field("hashes").type)], schema=_PARSED)


def extract(pages: DataFrame, per_root: float = PER_ROOT, least: int = LEAST) -> DataFrame:
    """``page_id, url, text, n_chars, n_template_blocks`` of every page."""
    ship(pages.sparkSession)
    host = F.nullif(F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html")
    parsed = write_table(rows.mapInArrow(
        _parse, "page_id long, url string, host string, sig long, texts array<string>, hashes array<array<long>>"), "html-blocks")
    seen = parsed.where(F.col("host").isNotNull())
    # one row per host, page text and subtree, then a count per host and subtree: both aggregate before they shuffle
    subtrees = seen.select("host", "sig", F.explode(F.array_distinct(F.flatten("hashes"))).alias("h")).distinct()
    counts = subtrees.groupBy("host", "h").agg(F.count("*").alias("n"))
    sites = seen.select("host", "sig").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    templates = write_table(
        counts.where(F.col("n") >= least).join(sites, "host").where(F.col("n") >= per_root * F.sqrt("pages"))
        .groupBy("host").agg(F.collect_set("h").alias("templates")), "html-templates")   # at most elements per page * root of pages / per_root
    none = F.lit([]).cast("array<bigint>")
    joined = parsed.join(templates, "host", "left").withColumn("templates", F.coalesce("templates", none))
    block = F.zip_with("texts", "hashes", lambda t, h: F.struct(t.alias("t"), h.alias("h")))
    kept = F.transform(F.filter(block, lambda b: ~F.arrays_overlap(b["h"], F.col("templates"))), lambda b: b["t"])
    joined = joined.withColumn("kept", F.when(F.size("templates") == 0, F.col("texts")).otherwise(kept))
    whole, left = F.array_join("texts", "\n\n"), F.array_join("kept", "\n\n")
    copy = F.size("kept") == 0
    return joined.select(
        "page_id", "url", F.when(copy, whole).otherwise(left).alias("text"),
        F.when(copy, F.lit(0)).otherwise(F.size("texts") - F.size("kept")).alias("n_template_blocks")
    ).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template_blocks")
