"""Operator 6: main text of web pages by consensus of each host's pages on a container path.

Every page scores its containers by the text in them that is no link and no boilerplate; its main one is the innermost that
holds all of it, or an article or main element with most of it. It votes for that container's path of tags and classes, in which numbers are
generalised. Spark counts the votes by host and path. Then every page is read again with its host's winning path; a page
without such a container, or with a small part of its text there, uses its own main one.
"""

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.tables import read
from palaver.workspace import write_once

DOMINANT = 0.75
SMALL = 0.5

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
RAW = re.compile(r"</(script|style|noscript|template|textarea|title|iframe|xmp)", re.I)
RAW_TAGS = frozenset("script style noscript template textarea title iframe xmp".split())
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body main article section div td center".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote caption dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html "
    "legend li menu nav ol p pre summary table tbody tfoot th thead tr ul".split()
)
EXCLUDED_TAGS = frozenset("aside button dialog footer head header input menu nav object select svg".split())
ARTICLES = frozenset("article main".split())
UNNAMED = frozenset("html body h1 h2 h3 h4 h5 h6".split())
#: Where an id is that of a part of the layout; on sections and headings it is a word of their title.
WITH_IDS = frozenset("div center td table ul ol form".split())
HEADER, COMMENTS, TEASERS, INSERTS, OTHER = range(1, 6)
KINDS = (
    (re.compile(r"headers?|masthead|banners?"), HEADER),
    (re.compile(r"comments?|disqus|replies"), COMMENTS),
    (re.compile(r"related|recommended"), TEASERS),
    (re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|share|sharing|newsletter|subscribe|signup|login|popup|modal"), INSERTS),
    (
        re.compile(
            r"notices?|alerts?|menus?|nav|navbar|navigation|breadcrumbs?|side|sidebars?|widgets?|footers?|social|search|forms?|contentinfo"
            r"|complementary"
        ),
        OTHER,
    ),
)
#: Words that say no more than where or how a named part is.
PLACES = frozenset("site main top bottom left right global primary secondary area bar wrapper wrap box container block inner outer list links buttons button items".split())
#: Words that as an id are as often that of a chapter.
CHAPTERS = re.compile(r"search|forms?|social|notices?|alerts?|side|share|sharing|replies|related|recommended|navigation|promo\w*|sponsor\w*|advert\w*")
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def kind_of_name(name: str) -> int:
    """What a whole class, id or role token names; 0 unless all its words are names of boilerplate or of places."""
    kind = 0
    for word in re.split(r"[-_]+", name.lower()):
        if word not in PLACES and not word.isdigit():
            own = next((k for names, k in KINDS if names.fullmatch(word)), 0)
            if not own:
                return 0
            kind = own if kind in (0, HEADER) else kind
    return kind


@lru_cache(100_000)
def kind_of(tag: str, classes: str, name: str, role: str) -> int:
    """The kind of boilerplate that an element's class, id and role speak for; 0 if none."""
    roles, kinds = role.split(), classes.split()
    if tag in UNNAMED or "main" in roles or "article" in roles:
        return 0
    tokens = kinds + roles
    if tag in WITH_IDS and "section" not in kinds and not CHAPTERS.fullmatch(name.lower()):
        tokens.append(name)
    return next((k for x in tokens if (k := kind_of_name(x))), 0)


class Named:
    """The elements of a page whose names, or whose being a form, speak for boilerplate; number 0 is the page itself."""

    def __init__(self):
        self.parents, self.kinds, self.holds, self.likes = [0], [0], [False], [None]

    def add(self, parent: int, kind: int, like: tuple) -> int:
        """A further one; ``like`` is the same for those that a template repeats."""
        self.parents.append(parent)
        self.kinds.append(kind)
        self.holds.append(False)
        self.likes.append((parent, *like))
        return len(self.parents) - 1

    def article(self, at: int) -> None:
        """An article or main element begins in ``at``; comments and teasers can have their own."""
        while not self.holds[at] and self.kinds[at] not in (COMMENTS, TEASERS):
            self.holds[at] = True
            at = self.parents[at]

    def left_out(self, found: list[tuple[str, list, int]]) -> list[bool]:
        """Which go. One stays that holds an article or main element, or with those like it most of the page's text that
        is no link, or most of that in articles. If there is an article, comments go and inserts such as advertisements
        are measured by what is in articles only. If no text is left, all stay."""
        n = len(self.parents)
        sizes = [[0, 0] for _ in range(n)]
        for _, parts, _ in found:
            for at, text, link, within in parts:
                if not link:
                    size = len(text.strip())
                    sizes[at][0] += size
                    sizes[at][1] += size * within
        gone = [self.holds[0] and kind == COMMENTS for kind in self.kinds]
        own = [size[0] for size in sizes]
        for at in range(n - 1, 0, -1):
            if not gone[at]:
                for k in (0, 1):
                    sizes[self.parents[at]][k] += sizes[at][k]
        alike: dict[tuple, list[int]] = {}
        for at in range(1, n):
            sums = alike.setdefault(self.likes[at], [0, 0])
            for k in (0, 1):
                sums[k] += sizes[at][k]
        for at in range(1, n):
            sums = alike[self.likes[at]]
            stays = self.holds[at] or any(2 * sums[k] > sizes[0][k] for k in ((1,) if self.holds[0] and self.kinds[at] == INSERTS else (0, 1)))
            gone[at] = gone[self.parents[at]] or gone[at] or not stays
        return gone if any(size and not out for size, out in zip(own, gone)) else [False] * n


def blocks(html: str) -> list[tuple[str, str, int, int]]:
    """The blocks of text outside boilerplate, in page order: (path of their containers, text, characters of links, level
    of the heading they are in or 0).

    Names are evidence only: ``Named.left_out`` says which named elements go when the whole page is read.
    """
    stack: list[tuple[str, str, bool, bool, int]] = [("", "", False, False, 0)]  # tag, path, excluded, link, named
    open_tags: dict[str, int] = {}
    found, parts, at, named = [], [], 0, Named()

    def flush() -> None:
        nonlocal parts
        if parts:
            found.append((stack[-1][1], parts, heading()))
            parts = []

    def say(text: str) -> None:
        _, _, excluded, link, name = stack[-1]
        if text and not excluded:
            parts.append((name, unescape(text), link, within()))

    def heading() -> int:
        return next((i for i in range(1, 7) if open_tags.get(f"h{i}")), 0)

    def within() -> bool:
        return bool(open_tags.get("article") or open_tags.get("main"))

    def pop() -> None:
        open_tags[stack.pop()[0]] -= 1

    while match := TOKEN.search(html, at):
        say(html[at : match.start()])
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if tag in BLOCKS:
                flush()
            if open_tags.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in RAW_TAGS:
            end = next((m for m in RAW.finditer(html, at) if m[1].lower() == tag), None)
            close = html.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else len(html)
            continue
        if tag in BLOCKS:
            flush()
            if open_tags.get("p"):
                _close(stack, pop, {"p"})
        elif tag == "br":
            say(" ")
        if tag in CLOSED_BY:
            _close(stack, pop, CLOSED_BY[tag])
        if tag in VOID or match[3].endswith("/") and tag not in BLOCKS:
            continue
        _, path, excluded, link, name = stack[-1]
        names = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(match[3])} if "=" in match[3] else {}
        inside = within()
        own = tag in EXCLUDED_TAGS and not (tag == "header" and inside)
        if not (own or excluded):
            kind = kind_of(tag, names.get("class", ""), names.get("id", ""), names.get("role", "")) if names else 0
            if kind == HEADER and inside or kind and (open_tags.get("pre") or open_tags.get("code")):
                kind = 0
            if tag == "form":
                kind = kind or OTHER
            if tag in ARTICLES and not (kind == COMMENTS and inside):
                kind = 0
                named.article(name)
            if kind:
                name = named.add(name, kind, (tag, names.get("class", "")))
        if tag in CONTAINERS:
            classes = names.get("class", "").split()
            path += ">" + tag + ("." + re.sub(r"\d+", "#", classes[0]) if classes else "")
        stack.append((tag, path, excluded or own, link or tag == "a", name))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    say(html[at:])
    flush()
    gone = named.left_out(found) if len(named.parents) > 1 else [False]
    said = []
    for path, parts, level in found:
        parts = [x for x in parts if not gone[x[0]]]
        if text := " ".join("".join(x[1] for x in parts).split()):
            said.append((path, text, sum(len(x[1]) for x in parts if x[2]), level))
    return said


def _close(stack, pop, tags: set[str]) -> None:
    """Close the innermost open one of the tags, if no container is between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] in tags:
            while len(stack) > i:
                pop()
            return
        if stack[i][0] in CONTAINERS or stack[i][0] in ("table", "ul", "ol", "dl"):
            return


def main_path(found: list[tuple[str, str, int, int]]) -> str | None:
    """The path of the container of the page's text; None if there is no text.

    It is the outermost article or main element with at least ``DOMINANT`` of the text, or else the innermost container
    outside of which there are only blocks of links. A heading of the first level counts as text though it is a link.
    """
    scores: dict[str, int] = {}
    children: dict[str, set[str]] = {}
    for path, text, links, level in found:
        score = len(text) if level == 1 else max(0, len(text) - 2 * links)
        steps = path.split(">")
        for i in range(1, len(steps) + 1):
            prefix = ">".join(steps[:i])
            scores[prefix] = scores.get(prefix, 0) + score
            if i > 1:
                children.setdefault(">".join(steps[: i - 1]), set()).add(prefix)
    at = ""
    if not scores.get(at):
        return None
    articles = [p for p, score in scores.items() if score >= DOMINANT * scores[at] and p.rpartition(">")[2].split(".")[0] in ARTICLES]
    if articles:
        return min(articles, key=lambda p: (p.count(">"), -scores[p], p))
    while whole := [c for c in children.get(at, ()) if scores[c] == scores[at]]:
        at = whole[0]
    return at


def text_at(found: list[tuple[str, str, int, int]], path: str | None) -> str:
    """The blocks in containers with this path, one a line.

    Those of the page's own main container if it has none with the path, if all its headings of the first level are
    elsewhere, or if less than ``SMALL`` of its text is in them and none of its headings of the highest level.
    """

    def within(path: str | None) -> list[tuple[str, str, int, int]]:
        return [b for b in found if path is not None and (b[0] == path or b[0].startswith(path + ">"))]

    def size(some: list[tuple[str, str, int, int]]) -> int:
        return sum(max(0, len(text) - 2 * links) for _, text, links, _ in some)

    def highest(some: list[tuple[str, str, int, int]]) -> int:
        return min((level for *_, level in some if level), default=7)

    inside = within(path)
    first = highest(found)
    elsewhere = first == 7 or highest(inside) > first
    if not inside or elsewhere and (first == 1 or size(inside) < SMALL * size(found)):
        inside = within(main_path(found)) or inside
    return "\n".join(text for _, text, _, _ in inside)


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            yield batch.slice(at, 200)


def host_paths(pages: DataFrame) -> DataFrame:
    """``host``, ``path``: the path with most votes; of equal ones the first in the alphabet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            paths = [main_path(blocks(html)) for html in part.column("html").to_pylist()]
            yield pa.record_batch([part.column("host"), pa.array(paths, pa.string())], names=["host", "path"])

    rows = pages.where("host <> ''").select("host", "html").mapInArrow(run, "host string, path string")
    votes = rows.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("votes"))
    return votes.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), "path")).alias("path"))


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    A null or empty page, and one without text outside boilerplate, has an empty text. A page whose url is null or has no
    host votes for nothing and uses its own main container. Repeated rows vote and come back as often as they are there,
    an empty table gives no rows, other columns are ignored.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"))
    winners = write_once(host_paths(pages), "host-paths").withColumnRenamed("host", "winner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [text_at(blocks(html), path) for html, path in zip(part.column("html").to_pylist(), part.column("path").to_pylist())]
            yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    joined = pages.join(winners, F.col("host") == F.col("winner"), "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(run, "page_id bigint, url string, text string")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_texts(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))
