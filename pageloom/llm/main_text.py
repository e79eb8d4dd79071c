"""Main text of web pages by consensus paths of their hosts.

Every page's containers are scored: a block of text counts for its container, half for the one around it, and text in
links counts against it. The page votes for the generalised path (tags and classes without digits, from the root down)
of its best container; Spark adds up the votes by host. Each page is then read again along its host's winning paths,
most votes first; a page that has none of them falls back on its own best container. From there it climbs to the whole
article: to the article or main element around it, and as far as nothing beside it is a list of links (see ``climbed``).
Every block there that isn't left out is kept.

Left out wherever they stand: menus, headers and footers of the page, sidebars, notices, adverts, forms, scripts,
styles, hidden parts and reader comments. A class or id marks such a part if all its words say so. One that says so by a
word among others, or by a word that may name a section as well (``related-work``, ``notice``, ``search``), leaves a part
of an article out only if it isn't prose: short, or mostly links, or with form fields, or without headings and
paragraphs. Text outside of markup is kept whole: character references decoded, white
space inside a block turned into one blank and trimmed, blocks in page order joined by an empty line. A line break
inside a block is white space.

A null or empty page gives an empty text, as does one without text; rows without url vote as one host. Markup may be
left unclosed or cut off anywhere; a tag that the page cuts off is dropped. Repeated rows vote and return each by itself.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.llm.texts import slices
from pageloom.operators.skew import broadcast_if_small
from pageloom.storage import durable

PATHS_A_HOST = 3

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
LISTS = frozenset("ul ol dl table tbody tr blockquote".split())
OUT, DOUBTFUL = 1, 2
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a page's main text never comes from, and words of class, id and role that mark such parts.
LEFT_OUT = frozenset("nav footer aside form button select option dialog head menu object canvas audio video".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert advertisement adverts advertising sponsor sponsored promo promotion nav navbar navigation menubar breadcrumb "
    "breadcrumbs sidebar widget masthead cookie cookies consent gdpr comment comments respond disqus newsletter subscribe subscription "
    "popup modal overlay pagination pager toolbar login signup complementary contentinfo".split()
)
#: Words that mark such parts too, but may as well name a section of an article.
DOUBTFUL_WORDS = frozenset("banner menu aside footer notice alert share sharing social related recommended search".split())
#: Words that say nothing about what an element holds.
NEUTRAL_WORDS = frozenset(
    "box block container wrapper wrap list item section area bar slot unit inner outer content body main page site global primary secondary "
    "top bottom left right head header foot wide small large sticky fixed first last row col column panel group holder region zone text link "
    "links icon icons button buttons form js mobile desktop".split()
)
#: Doubtful parts of an article stay if they are prose: so many characters outside of links, at most this share in links.
PROSE_CHARS, PROSE_LINKED = 200, 0.25
#: Paths longer than this get no vote; such a page goes by its own best container.
PATH_CHARS = 2_000
#: An element of the first kind ends open ones of the second, up to the nearest of the third.
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


@dataclass
class Page:
    """Elements in page order and blocks of text with their element; what is told of an element costs the same at any depth."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    name: list[str] = field(default_factory=list)
    #: Whether left out, and whether that hangs on what the element holds.
    out: list[bool] = field(default_factory=list)
    doubtful: list[int] = field(default_factory=list)
    #: Whether in an article or main element, the element that lists count for, and the number of the path.
    within: list[bool] = field(default_factory=list)
    lifted: list[int] = field(default_factory=list)
    place: list[int] = field(default_factory=list)
    places: dict[tuple[int, str], int] = field(default_factory=dict)
    fields: dict[int, int] = field(default_factory=dict)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def open(self, parent: int, tag: str, attributes: str) -> int:
        node = len(self.tag)
        name, out, within = tag, parent >= 0 and self.out[parent], parent >= 0 and self.within[parent]
        if attributes and not attributes.isspace():
            name, marked = _described(tag, attributes)
            out |= marked == OUT
            if marked == DOUBTFUL and not out:
                self.doubtful.append(node)
        self.parent.append(parent)
        self.tag.append(tag)
        self.name.append(name)
        self.out.append(out or tag in LEFT_OUT or (tag == "header" and not within))
        self.within.append(within or tag in ("article", "main"))
        self.lifted.append(self.lifted[parent] if tag in LISTS and parent >= 0 else node)
        self.place.append(self.places.setdefault((self.place[parent] if parent >= 0 else -1, name), len(self.places)))
        return node

    def settle(self) -> None:
        """Leave out the doubtful elements that are no prose of an article and hold no article."""
        if not self.doubtful:
            return
        count = len(self.tag)
        length, linked, parts, fields, holds = ([0] * count for _ in range(5))
        for node, text, n in self.blocks:
            if not self.out[node]:
                length[node] += len(text)
                linked[node] += n
                parts[node] += 2 if self.tag[node] in HEADINGS else 1 if self.tag[node] == "p" else 0
        for node, n in self.fields.items():
            fields[node] += n
        for node in range(count - 1, 0, -1):
            if (parent := self.parent[node]) >= 0:
                for own in (length, linked, parts, fields, holds):
                    own[parent] += own[node]
                holds[parent] += self.tag[node] in ("article", "main")
        for node in self.doubtful:
            prose = length[node] - linked[node] >= PROSE_CHARS and linked[node] <= PROSE_LINKED * length[node] and parts[node] >= 2 and not fields[node]
            if not (prose if self.within[node] else holds[node]):
                self.out[node] = True
        for node, parent in enumerate(self.parent):
            if parent >= 0 and self.out[parent]:
                self.out[node] = True

    def find(self, path: str) -> int | None:
        """The number of a path, if the page has it."""
        place: int | None = -1
        for name in path.split(">"):
            place = self.places.get((place, name))
            if place is None:
                return None
        return place

    def _up(self, node: int) -> Iterator[int]:
        while node >= 0:
            yield node
            node = self.parent[node]

    def path(self, node: int) -> str:
        names = []
        while node >= 0:
            names.append(self.name[node])
            node = self.parent[node]
        return ">".join(reversed(names))

    def scores(self) -> dict[int, float]:
        """Score of every container that holds text."""
        found: dict[int, float] = {}
        for node, text, linked in self.blocks:
            if self.out[node]:
                continue
            worth = len(text) - 2 * linked
            container = node
            if self.tag[node] not in ("div", "section", "article", "main", "body", "td"):
                container = self.parent[node]
                container = self.lifted[container] if container >= 0 else container
            if container >= 0:
                found[container] = found.get(container, 0.0) + worth
                around = self.parent[container]
                if around >= 0:
                    found[around] = found.get(around, 0.0) + worth / 2
        return found

    def climbed(self, nodes: list[int]) -> set[int]:
        """The elements that hold the whole article of which the given ones are a part.

        Inside an article or main element that is the nearest one. From there, or
        from the elements themselves, it goes on to the element around as long as
        nothing in that is mostly links; out of an article or main element only to
        a main element.
        """
        length, linked = [0] * len(self.tag), [0] * len(self.tag)
        menus: list[int] = [0] * len(self.tag)
        for node, text, n in self.blocks:
            if not self.out[node]:
                length[node] += len(text)
                linked[node] += n
        menu = [False] * len(self.tag)
        loose = [2 * n > size for n, size in zip(linked, length, strict=True)]
        for node in range(len(self.tag) - 1, -1, -1):
            parent = self.parent[node]
            menu[node] = 2 * linked[node] > length[node] and self.tag[node] != "p" and self.tag[node] not in HEADINGS
            if parent >= 0:
                length[parent] += length[node]
                linked[parent] += linked[node]
                menus[parent] += menu[node]
        found = set()
        for node in nodes:
            whole = next((n for n in self._up(node) if self.tag[n] in ("article", "main")), None)
            top = node if whole is None else whole
            mains = {n for n in self._up(top) if self.tag[n] == "main"}
            at = top
            while (around := self.parent[at]) >= 0 and not loose[around] and menus[around] == menu[at]:
                at = around
                if whole is None or at in mains:
                    top = at
            found.add(top)
        return found

    def text(self, roots: set[int]) -> str:
        """Blocks under the given elements."""
        inside = [False] * len(self.tag)
        for node, parent in enumerate(self.parent):
            inside[node] = node in roots or (parent >= 0 and inside[parent])
        return "\n\n".join(text for node, text, _ in self.blocks if inside[node] and not self.out[node])


_DESCRIBED: dict[tuple[str, str], tuple[str, int]] = {}


def _described(tag: str, attributes: str) -> tuple[str, int]:
    """Generalised name of an element, and whether its attributes mark it as left out, perhaps, or not (0)."""
    key = (tag, attributes)
    if key not in _DESCRIBED:
        if len(_DESCRIBED) > 50_000:
            _DESCRIBED.clear()
        given = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
        classes = sorted({c for c in (_DIGITS.sub("", c).strip("-_") for c in given.get("class", "").split()) if c})
        marked = 0
        if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", ""):
            marked = OUT
        elif tag not in ("html", "body", "article", "main"):
            for token in " ".join(given.get(k, "") for k in ("class", "id", "role")).split():
                marked = OUT if marked == OUT else _marks(token) or marked
        _DESCRIBED[key] = ".".join([tag, *classes]), marked
    return _DESCRIBED[key]


def _marks(token: str) -> int:
    """A class or id marks its element for sure if all its words do or say nothing, and perhaps if one of several does."""
    words = set(_WORD.findall(token)) - NEUTRAL_WORDS
    if words and words <= LEFT_OUT_WORDS:
        return OUT
    return DOUBTFUL if words & (LEFT_OUT_WORDS | DOUBTFUL_WORDS) else 0


def parse(source: str) -> Page:
    page = Page()
    stack: list[int] = []
    opened: Counter[str] = Counter()
    held: list[str] = []
    linked = 0
    links = 0
    at, end = 0, len(source)
    lowered: str | None = None

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                if not stack:
                    stack.append(page.open(-1, "body", ""))
                    opened["body"] += 1
                node = stack[-1]
                while page.tag[node] not in BLOCKS and page.parent[node] >= 0:
                    node = page.parent[node]
                page.blocks.append((node, text, min(linked, len(text))))
            held.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal links
        if any(page.tag[n] in BLOCKS for n in stack[depth:]):
            flush()
        for node in stack[depth:]:
            links -= page.tag[node] == "a"
            opened[page.tag[node]] -= 1
        del stack[depth:]

    match = _TOKEN.match
    while at < end:
        found = match(source, at)
        at = found.end()
        tag = found.group(2)
        if tag is None:
            text = found.group()
            if text[0] != "<" or len(text) == 1:
                text = html.unescape(text) if "&" in text else text
                held.append(text)
                if links:
                    linked += len(text)
            continue
        tag = tag.lower()
        if found.group(1):
            if tag == "br":
                held.append(" ")
                continue
            for depth in range(len(stack) - 1 if opened[tag] else -1, -1, -1):
                open_tag = page.tag[stack[depth]]
                if open_tag == tag:
                    close(depth)
                    break
                if tag not in BLOCKS and open_tag in BLOCKS:
                    break  # an inline end tag doesn't close blocks
            else:
                if tag in BLOCKS:
                    flush()
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in RAW:
            if lowered is None:
                lowered = source.lower()
            if len(lowered) != end:  # rare letters change their length in lower case
                stop = re.compile(f"</{tag}", re.I).search(source, at)
                at = stop.start() if stop else end
            else:
                stop = lowered.find(f"</{tag}", at)
                at = stop if stop >= 0 else end
            continue
        if tag in BLOCKS:
            flush()
            if tag in _CLOSED_BY:
                ends, limits = _CLOSED_BY[tag]
            else:
                ends, limits = {"p"}, {"button", "td", "th", "li"}
            for depth in range(len(stack) - 1 if any(opened[t] for t in ends) else -1, -1, -1):
                if page.tag[stack[depth]] in limits:
                    break
                if page.tag[stack[depth]] in ends:
                    close(depth)
                    if tag != "tr":
                        break
        if tag == "input" and stack:
            page.fields[stack[-1]] = page.fields.get(stack[-1], 0) + 1
        if tag in VOID or found.group(3).endswith("/") and tag not in BLOCKS and tag != "a":
            continue
        if tag in ("html", "body") and opened[tag]:
            continue
        stack.append(page.open(stack[-1] if stack else -1, tag, found.group(3)))
        opened[tag] += 1
        links += tag == "a"
    flush()
    page.settle()
    return page


def best_container(page: Page) -> int | None:
    """The container with the highest score; the first of equals."""
    scores = page.scores()
    return min(scores, key=lambda n: (-scores[n], n)) if scores else None


def extract(source: str | None, paths: list[str] | None) -> str:
    """Main text of a page along the first winning path that it has, or of its own best container."""
    if not source:
        return ""
    page = parse(source)
    scores = page.scores()
    if not scores:
        return ""
    named: dict[int, list[int]] = {}
    for node in scores:
        named.setdefault(page.place[node], []).append(node)
    for path in paths or []:
        if (place := page.find(path)) in named:
            return page.text(page.climbed(named[place]))
    return page.text(page.climbed(named[page.place[min(scores, key=lambda n: (-scores[n], n))]]))


def host_of(url: str = "url") -> F.Column:
    """Lower-case host of a url; empty for a null or odd one."""
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, votes, weight``: one vote for each page with text, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[tuple[str, str], list[float]] = {}
        for batch in slices(batches, "html"):
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                if not source:
                    continue
                page = parse(source)
                node = best_container(page)
                path = "" if node is None else page.path(node)
                if 0 < len(path) <= PATH_CHARS:
                    own = counted.setdefault((host, path), [0, 0.0])
                    own[0] += 1
                    own[1] += len(page.text({node}))
            if len(counted) > 10_000:
                yield _vote_rows(counted)
                counted = {}
        if counted:
            yield _vote_rows(counted)

    cast = pages.select(host_of().alias("host"), F.col("html").cast("string").alias("html"))
    found = cast.mapInArrow(run, "host string, path string, votes bigint, weight double")
    return found.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("weight").alias("weight"))


def _vote_rows(counted: dict[tuple[str, str], list[float]]) -> pa.RecordBatch:
    hosts, paths = zip(*counted, strict=True)
    counts, weights = zip(*counted.values(), strict=True)
    columns = [pa.array(hosts), pa.array(paths), pa.array([int(c) for c in counts], pa.int64()), pa.array(np.array(weights))]
    return pa.RecordBatch.from_arrays(columns, names=["host", "path", "votes", "weight"])


def winning_paths(pages: DataFrame, paths_a_host: int = PATHS_A_HOST) -> DataFrame:
    """``host, paths``: the paths with most votes, ties to the one with more text, then by name."""
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("weight"), "path")
    ranked = votes(pages).withColumn("place", F.row_number().over(order)).where(F.col("place") <= paths_a_host)
    listed = ranked.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "path"))).alias("ranked"))
    return listed.select("host", F.col("ranked.path").alias("paths"))


def main_text(pages: DataFrame, paths_a_host: int = PATHS_A_HOST) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    winners = broadcast_if_small(durable(winning_paths(pages, paths_a_host), "winning_paths"))
    cast = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    joined = cast.withColumn("host", host_of()).join(winners, "host", "left").select("page_id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [extract(h, p) for h, p in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
