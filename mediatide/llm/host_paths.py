"""Main text of web pages by consensus of a host's pages on where it stands.

Each page is read into a tree of containers.  Boilerplate is named as such (menus, headers, footers, sidebars, notices,
adverts, forms, comments); a container scores by the rest of the running text that it holds itself or in equally named parts, less what links and
other parts hold, and more if it is marked as main content.  Its generalised path (tags and classes from the root on, runs of digits as one #, states of a page left out) is the page's
vote.  Votes are counted per host in Spark; the paths with at least `least_percent` of a host's votes win, in order of
votes.  Every page is then read again: the text is that of all containers at the first winning path the page has,
without the boilerplate inside; a page with none of them uses the container that it voted for itself.

Texts are whole: character references are decoded, white space (as str.split() knows it) inside a block becomes one space, blocks
without text vanish, the others are joined in page order by one space.

Defined results: null and empty html have no text; a null url, or one without a host, is of the empty host; broken markup is read as far
as it goes (unclosed elements end with their parent or the page, a tag cut off at the end is no text); repeated rows are
pages of their own; equal scores go to the container that comes first, equal votes to the higher score, then to the path in
order.  Very long and very deep pages are read whole.  Only page_id, url and html are read.  An empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import prepare, store, table

#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
#: Elements that never hold a page's text.
SILENT = RAW | frozenset("head template svg math canvas object audio video map select datalist button nav footer aside menu dialog".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var".split()
)
#: An open element that the same or another start tag ends, and what such a search does not go beyond.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold blocks but are no candidates for the whole text.
PARTS = INLINE | HEADINGS | frozenset(
    "p li ul ol dl dt dd table thead tbody tfoot tr caption pre blockquote figure figcaption header address summary details fieldset legend".split()
)
#: Words of classes, ids and roles.  A container so named is left out, unless it holds the page's main element; those of the second kind
#: also stay if they hold most of the page's running text.
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr popup modal"
    " overlay notice notices alert banner newsletter subscribe subscription signup login share sharing sharebar social follow related"
    " recommended recommendations breadcrumb breadcrumbs pagination pager comment comments commentlist commentform respond disqus replies"
    " reply navbar navigation contentinfo complementary search toc skip skiplink copyright hidden teaser teasers tags meta byline".split()
)
WEAK = frozenset("sidebar menu nav topbar masthead header footer foot toolbar dialog form".split())
MAIN = frozenset("article main content post entry story articlebody maincontent body text".split())
STATES = ("has-", "no-", "with-", "is-", "without-", "js-")
STATE_ENDS = ("-open", "-closed", "-enabled", "-disabled", "-active")

#: Classes that differ between pages of one kind.
VARYING = ("category-", "tag-", "author-", "status-", "format-", "parent-")

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Container:
    """An element that can hold blocks: where it is, and what stands below it."""

    __slots__ = ("parent", "tag", "path", "weak", "silent", "main", "header", "comment", "running", "links", "holds_main", "inside")

    def __init__(self, parent: Container | None, tag: str, name: str):
        self.parent, self.tag = parent, tag
        #: The generalised path as a number, so that deep pages cost no more than flat ones; spelled out only for the vote.
        self.path = xxhash.xxh3_64_intdigest(name, parent.path if parent else 0)
        self.weak = self.silent = self.main = self.header = self.comment = self.holds_main = False
        self.running = self.links = 0
        self.inside = 0


class Page:
    """Containers in page order and text runs: (container, in a link, text) or None for the border of a block."""

    def __init__(self, html: str):
        root = Container(None, "", "")
        self.containers, self.names, self.runs = [root], [""], []
        self._read(html, root)
        self._weigh()

    # -- reading

    def _read(self, html: str, root: Container) -> None:
        # Open elements: (tag, container or None for inline ones and paragraphs).
        stack: list[tuple[str, Container]] = [("", root)]
        opened: Counter = Counter()

        def close(at: int) -> int:
            """Closes the elements from `at` on; how many of them are links."""
            names = [name for name, _ in stack[at:]]
            opened.subtract(names)
            del stack[at:]
            return names.count("a")

        links, at, end = 0, 0, len(html)
        runs = self.runs
        while at < end:
            open_ = html.find("<", at)
            if open_ < 0:
                open_ = end
            if open_ > at:
                runs.append((stack[-1][1], links > 0, html[at:open_]))
            if open_ == end:
                break
            m = _TAG.match(html, open_)
            if m is None:
                # A lone < is text; a cut-off tag was matched to the end.
                runs.append((stack[-1][1], links > 0, "<"))
                at = open_ + 1
                continue
            at = m.end()
            g = 1 if m.group(2) else 5
            tag = m.group(g + 1)
            if tag is None:
                continue
            if not m.group(g + 3):
                break
            tag = tag.lower()
            if m.group(g):
                if tag == "br":
                    runs.append(None)
                    continue
                # Inline ends stay within their block; block ends close what is open inside.
                inline = tag in INLINE
                for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                    name = stack[i][0]
                    if name == tag:
                        links -= close(i)
                        break
                    if inline and name not in INLINE:
                        break
                if not inline:
                    runs.append(None)
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    runs.append(None)
                continue
            if tag not in INLINE:
                runs.append(None)
                at_most = self._ended(stack, opened, tag)
                if at_most is not None:
                    links -= close(at_most)
            attributes = m.group(g + 2)
            if tag in RAW:
                ending = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                if ending is None:
                    # Without an end, a title or a script takes the rest of the page.
                    break
                at = html.find(">", ending.start()) + 1 or end
                runs.append(None)
                continue
            if tag in ("svg", "math") and attributes.endswith("/"):
                continue
            container = stack[-1][1]
            if (tag not in INLINE and tag != "p") or any(x in attributes for x in ("class", "id", "role", "hidden", "style")):
                container = self._container(container, tag, attributes)
            if tag == "a":
                links += 1
            stack.append((tag, container))
            opened[tag] += 1
        runs.append(None)

    @staticmethod
    def _ended(stack: list[tuple[str, Container]], opened: Counter, tag: str) -> int | None:
        """From which open element on a start tag ends them, if it does."""
        names, borders = ENDED_BY.get(tag, (set(), set()))
        if any(opened[name] for name in names):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in names:
                    return i
                if stack[i][0] in borders:
                    break
        # A paragraph is ended by any block within its own container.
        if opened["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    return i
                if stack[i][0] not in INLINE:
                    break
        return None

    def _container(self, parent: Container, tag: str, attributes: str) -> Container:
        classes, words, role, own_id, flagged = [], set(), "", "", False
        if attributes and not attributes.isspace():
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), a or b or c
                if name == "class":
                    classes = unescape(value).split()
                    names = classes
                elif name in ("id", "itemprop", "data-role"):
                    names = unescape(value).split()
                    if name == "id" and not _DIGITS.search(value):
                        own_id = "#" + value.strip().lower()
                elif name == "role":
                    role = value.lower().strip()
                    names = [role]
                elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
                    flagged = True
                    continue
                else:
                    continue
                for x in names:
                    low = x.lower()
                    if not low.startswith(STATES) and not low.endswith(STATE_ENDS):
                        words.update(p.lower() for p in _PART.findall(x))
        lasting = (x.lower() for x in classes if not x.lower().startswith(STATES + VARYING) and not x.lower().endswith(STATE_ENDS))
        shown = sorted({_DIGITS.sub("#", x) for x in lasting})
        name = ".".join([tag, *shown]) if shown else tag + own_id
        out = Container(parent, tag, name)
        first = {x.split("-")[0].split("_")[0] for x in shown}
        out.comment = tag not in ("html", "body", "main") and bool(first & {"comment", "comments", "commentlist", "reply", "replies"})
        out.main = (tag in ("article", "main") or role in ("main", "article") or bool(words & MAIN)) and not out.comment
        own = tag in ("body", "html", "main") or (tag == "article" and not out.comment)
        out.silent = flagged or tag in SILENT or (not own and bool(words & STRONG)) or out.comment
        out.weak = not own and not out.silent and (tag in ("header", "form") or bool(words & WEAK))
        out.header = out.weak and (tag == "header" or "header" in words)
        # A sidebar may hold articles that are teasers, but no main element and nothing called the content.
        if tag == "main" or (out.main and tag != "article" and not out.silent and not out.weak):
            up = parent
            while up is not None and not up.holds_main:
                up.holds_main = True
                up = up.parent
        self.containers.append(out)
        self.names.append(name)
        return out

    # -- scoring

    def _weigh(self) -> None:
        """Running and link text below every container, and which of the weakly named ones are boilerplate."""
        for run in self.runs:
            if run is not None:
                where, link, text = run
                n = len(text) - text.count(" ") - text.count("\n")
                if n:
                    if link:
                        where.links += n
                    else:
                        where.running += n
        for c in reversed(self.containers):
            c.inside = c.running + c.inside
            if c.parent is not None:
                c.parent.inside += c.inside
        whole = self.containers[0].inside
        for c in self.containers:
            if c.weak:
                c.silent = not c.holds_main and 2 * c.inside <= whole
            elif c.silent and c.holds_main and c.tag not in SILENT and not c.comment:
                c.silent = False
            if c.parent is not None and c.parent.silent:
                c.silent = True

    def best(self) -> Container:
        """The container with the highest score.

        A container has the score of its own text and of the best group of equally named containers in it, less half of
        what the others hold; so parts of one text add up, and what stands beside it is a loss.
        """
        own: dict[Container, float] = {}
        groups: dict[Container, dict[str, float]] = {}
        top, most = self.containers[0], 0.0
        scores = []
        for c, name in zip(reversed(self.containers), reversed(self.names), strict=True):
            if c.silent:
                continue
            direct = own.pop(c, 0.0) + c.running - c.links / 2
            parts = groups.pop(c, None)
            if c.tag in PARTS:
                own[c.parent] = own.get(c.parent, 0.0) + direct
                for other, score in (parts or {}).items():
                    held = groups.setdefault(c.parent, {})
                    held[other] = held.get(other, 0.0) + score
                continue
            score = direct
            if parts:
                largest = max(parts.values())
                score += largest - (sum(parts.values()) - largest) / 2 - 4
            scores.append((c, score))
            if c.parent is not None and score > 0:
                held = groups.setdefault(c.parent, {})
                held[name] = held.get(name, 0.0) + score
        for c, score in scores:
            weighted = score * (2 if c.tag in ("article", "main") else 1.1 if c.main else 1)
            # The scores come from the last container to the first.
            if weighted >= most:
                top, most = c, weighted
        self.score = int(most)
        return top

    def spelled(self, c: Container) -> str:
        names = dict(zip(map(id, self.containers), self.names, strict=True))
        parts = []
        while c.parent is not None:
            parts.append(names[id(c)])
            c = c.parent
        return ">".join(reversed(parts))

    # -- extraction

    def text(self, path: int) -> str:
        """The blocks of all containers at the path, boilerplate inside them left out; a header inside keeps its headings."""
        kept: dict[Container | None, bool] = {None: False}
        for c in self.containers:
            up = c.parent
            chosen = c.path == path
            # What wins the vote is text even if its name says otherwise.
            kept[c] = chosen or (kept[up] and not c.silent)
            if c.tag in HEADINGS and up is not None and up.header and kept[up.parent] and up.parent.tag not in ("", "html", "body"):
                kept[c] = True
        parts = []
        for run in self.runs:
            if run is None:
                parts.append(" ")
            elif kept[run[0]]:
                parts.append(unescape(run[2]) if "&" in run[2] else run[2])
        return " ".join("".join(parts).split())


def host_of(url: str) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(F.col(url).cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, path, spelled, votes, score), added up in each batch."""
    for batch in batches:
        found: dict[tuple[str, int], list] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if html:
                page = Page(html)
                top = page.best()
                row = found.get((host, top.path))
                if row is None:
                    row = found[host, top.path] = [page.spelled(top), 0, 0]
                row[1] += 1
                row[2] += page.score
        rows = [(h, _signed(p), *x) for (h, p), x in found.items()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ["host", "path", "spelled", "votes", "score"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def _signed(path: int) -> int:
    return path - (1 << 64) if path >> 63 else path


def host_paths(pages: DataFrame, least_percent: int = 5) -> DataFrame:
    """host, paths: the winning paths of each host in order, at most 100 / least_percent, as (path, spelled, votes, score)."""
    prepare(pages.sparkSession)
    html = pages.select(host_of("url").alias("host"), F.col("html").cast("string").alias("html"))
    votes = html.mapInArrow(_votes, "host string, path long, spelled string, votes long, score long")
    votes = votes.groupBy("host", "path").agg(
        F.sum("votes").alias("votes"), F.sum("score").alias("score"), F.min("spelled").alias("spelled")
    )
    votes = store(votes, "votes")
    totals = votes.groupBy("host").agg(F.sum("votes").alias("all"))
    won = votes.join(totals, "host").where(F.expr(f"100 * votes >= {least_percent} * all"))
    order = F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), "spelled", "path")
    return won.groupBy("host").agg(F.sort_array(F.collect_list(order)).alias("paths")).select(
        "host", F.transform("paths", lambda x: F.struct(x["path"].alias("path"), x["spelled"].alias("spelled"), (-x["v"]).alias("votes"), (-x["s"]).alias("score"))).alias("paths")
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist(), strict=True):
            if not html:
                texts.append("")
                continue
            page = Page(html)
            there = {_signed(c.path): c.path for c in page.containers}
            chosen = next((there[p] for p in paths or () if p in there), None)
            texts.append(page.text(page.best().path if chosen is None else chosen))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def main_texts(pages: DataFrame, least_percent: int = 5) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    winners = store(host_paths(pages, least_percent), "host_paths")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    # Few paths a host: Spark broadcasts them while they are few, and splits a large host's pages where it shuffles.
    joined = rows.withColumn("host", host_of("url")).join(winners.select("host", F.col("paths.path").alias("paths")), "host", "left")
    return joined.select("page_id", "url", "html", "paths").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")


def op11_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
