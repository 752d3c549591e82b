"""Main text of web pages by consensus of each host's pages on the path of the main container.

First pass: each page is cut into blocks, each with the path of its containers, where a step is a tag with its classes, numbers in
them generalised. Containers are scored by the text of their own blocks without links; the best one is widened to
the article or main element that it is in, or else to its parents as long as these bring no menu, link or other page
furniture, and gets the page's vote. Spark sums the
votes by host and path, within each task first. Second pass: each page is cut again, and its text is what stands below the host's winning
path, or the next in votes that the page has, without furniture. A page that has none uses its own container.

Furniture is known by tag (nav, footer, form, ...) or by a word in class, id or role. Words are of two kinds. Some name what is never the
article: comments, notices, adverts. Others name a place in a layout (sidebar, menu, search, share, ...) and are often put on what holds the
article, too: they count for nothing on html, body and main, nor where they are part of a state (no-sidebar, has-share,
comments-open), nor around an article or main element, nor on a page that has no other text. What a host's own pages agree on decides the
rest. Containers deeper than DEEPEST are no further steps of a path. Votes are a few rows for each host; they are broadcast up to a counted size and joined
beyond it.

Text: character references are decoded, white space in a block becomes one space, blocks are joined in page order by one space.
Defined results: a null or empty html has no text; markup that is never closed ends with the page; a null url is a host of
its own. Rows that repeat vote and are extracted like others. Further columns take no part, whatever their names. An empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import ship, sized, written

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)>|<[!?][^>]*>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[A-Za-z]+")
_NUMBER = re.compile(r"\d+")

# Elements of HTML and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template svg iframe object title head select option textarea button canvas".split())
RAW = frozenset("script style title textarea".split())
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}
FURNITURE_TAGS = frozenset("nav footer aside form dialog menu".split())
NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "comment comments commentlist reply replies disqus respond newsletter subscribe subscription signup login legal copyright disclaimer".split()
)
LAYOUT_WORDS = frozenset(
    "overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar share sharing social related "
    "recommended search pagination pager widget widgets skip complementary contentinfo".split()
)
#: Parts of a hyphenated name that make it a state of the page and not the name of a part.
STATES = frozenset("no has with without is have open opened closed fixed enabled disabled active inactive hidden visible on off sticky".split())
PLAIN_TAGS = frozenset("html body main".split())
#: Page headers, unless within an article.
HEADER_WORDS = frozenset("header".split())
ARTICLE = frozenset("article main".split())
#: Blocks of text, which are no step of a path.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dt dd figcaption td th tr tbody thead tfoot caption address summary".split())
CONTAINERS = frozenset("html body div section article main header footer nav aside form ul ol dl table figure details fieldset center menu dialog hgroup".split())
#: What the start of a tag closes: an open paragraph, or an element of its own kind.
ENDS_PARAGRAPH = CONTAINERS | (TEXT_BLOCKS - frozenset("td th tr tbody thead tfoot caption".split())) | {"hr"}
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}}
ENDS_AT = frozenset("ul ol dl table".split())


#: Containers on a path.
DEEPEST = 200
#: How surely a block is furniture: by a layout word, or by a tag or another word.
BY_LAYOUT, SURELY = 1, 2


class _Element:
    __slots__ = ("tag", "path", "depth", "furniture", "unseen", "link", "article")

    def __init__(self, tag: str, path: str, depth: int, furniture: int, unseen: bool, link: bool, article: bool):
        self.tag, self.path, self.depth, self.furniture, self.unseen, self.link, self.article = tag, path, depth, furniture, unseen, link, article


def _names(value: str) -> set[str]:
    """Words of a class, id or role, without those of names that are states."""
    out: set[str] = set()
    for name in value.split():
        words = _PARTS.findall(name)
        if len(words) < 2 or STATES.isdisjoint((words[0], words[-1])):
            out.update(words)
    return out


def _opened(tag: str, attributes: str, parent: _Element) -> _Element:
    names, classes = set(), ""
    if "=" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = (values[0] or values[1] or values[2]).lower()
            names |= _names(value)
            if name.lower() == "class":
                classes = ".".join(sorted(_NUMBER.sub("#", value).split()))
    article = parent.article or tag in ARTICLE
    furniture = parent.furniture
    if tag in ARTICLE and furniture == BY_LAYOUT:
        furniture = 0
    if tag in FURNITURE_TAGS or not names.isdisjoint(NEVER_WORDS) and tag not in PLAIN_TAGS:
        furniture = SURELY
    elif not names.isdisjoint(LAYOUT_WORDS) and tag not in PLAIN_TAGS:
        furniture = max(furniture, BY_LAYOUT)
    if not article and tag not in PLAIN_TAGS and (tag == "header" or not names.isdisjoint(HEADER_WORDS)):
        furniture = SURELY if tag == "header" else max(furniture, BY_LAYOUT)
    path, depth = parent.path, parent.depth
    if tag in CONTAINERS and tag != "html" and depth < DEEPEST:
        path, depth = (f"{path}/{tag}.{classes}" if classes else f"{path}/{tag}"), depth + 1
    return _Element(tag, path, depth, furniture, parent.unseen or tag in UNSEEN, parent.link or tag == "a", article)


def blocks(html: str) -> list[tuple[str, str, int, bool]]:
    """(path, text, characters of links, furniture) of each block of text, in page order.

    Layout words count as furniture only if the page has other text.
    """
    found = _blocks(html)
    least = BY_LAYOUT if any(not furniture and links < len(text) for _, text, links, furniture in found) else SURELY
    return [(path, text, links, furniture >= least) for path, text, links, furniture in found]


def _blocks(html: str) -> list[tuple[str, str, int, int]]:
    root = _Element("", "", 0, 0, False, False, False)
    stack, out = [root], []
    open_tags: Counter = Counter()
    parts: list[str] = []
    links, start, at = 0, root, 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((start.path, text, min(links, len(text)), start.furniture))
            parts.clear()
        links = 0

    def read(piece: str) -> None:
        nonlocal links, start
        top = stack[-1]
        if piece and not top.unseen:
            if parts and (top.furniture != start.furniture or top.path != start.path):
                flush()  # an inline element that is furniture, or text right after a container
            if not parts:
                start = top
            parts.append(piece)
            if top.link:
                links += len(piece.strip())

    def close(i: int) -> None:
        """Closes the elements from the i-th on."""
        for element in stack[i:]:
            open_tags[element.tag] -= 1
        del stack[i:]

    # No tag ends behind the last sign that can end one, so what stands there is not searched from each of its beginnings.
    position, size, last = 0, len(html), html.rfind(">") + 1
    while position < last:
        token = _TOKEN.search(html, position, last)
        if token is None:
            break
        read(html[at : token.start()])
        at = position = token.end()
        if token[0].startswith("<!--") and not (token[0].endswith("-->") and len(token[0]) > 6):
            at = size  # a comment that is never closed
            break
        end, tag = token[1], token[2]
        if tag is None:
            continue
        tag = tag.lower()
        block = tag in CONTAINERS or tag in TEXT_BLOCKS
        if end:
            if block or tag == "br":
                flush()
            if open_tags[tag]:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                close(i)
            continue
        if block or tag in ("br", "hr"):
            flush()
        if tag in ENDS_PARAGRAPH and open_tags["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in CONTAINERS:
                    break
        if (same := ENDS_SAME.get(tag)) and any(open_tags[other] for other in same):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in same:
                    close(i)
                    break
                if stack[i].tag in ENDS_AT or stack[i].tag in CONTAINERS:
                    break
        if tag in VOID or token[3].endswith("/") and tag not in CONTAINERS and tag not in TEXT_BLOCKS:
            continue
        stack.append(_opened(tag, token[3], stack[-1]))
        open_tags[tag] += 1
        if tag in RAW:  # its content is text up to its own end tag
            ended = _RAW_END[tag].search(html, position)
            position = at = ended.start() if ended else size
            if ended is None:
                break
    rest = html[at:]
    read(rest[: rest.find("<!--")] if "<!--" in rest else rest)
    flush()
    return out


def _above(path: str) -> Iterator[str]:
    """The path and its parents, the empty one last."""
    while path:
        yield path
        path = path.rpartition("/")[0]
    yield ""


def main_container(found: list[tuple[str, str, int, bool]]) -> tuple[str, float] | None:
    """The path of a page's main container and the share of the page's unlinked text below it; none without such text."""
    own, other, below, bad = Counter(), Counter(), Counter(), Counter()
    for path, text, links, furniture in found:
        good = 0 if furniture else len(text) - links
        own[path] += good
        other[path] += len(text) - good
    for path, good in own.items():
        for step in _above(path):
            below[step] += good
            bad[step] += other[path]
    total = below[""]
    if not total:
        return None
    best = max(own, key=lambda path: (own[path], path))
    best = next((path for path in _above(best) if path.rpartition("/")[2].partition(".")[0] in ARTICLE), best)
    while "/" in best:
        tag = best.rpartition("/")[2].partition(".")[0]
        parent = best.rpartition("/")[0]
        if tag in ARTICLE or parent in ("", "/body") or bad[parent] > bad[best]:
            break
        best = parent
    return best, below[best] / total


def main_text(found: list[tuple[str, str, int, bool]], paths: list[str]) -> str:
    """The text below the first of the paths that has some, or else below the page's own container."""

    def below(path: str) -> str:
        deeper = path + "/"
        return " ".join(text for at, text, _, furniture in found if not furniture and (at == path or at.startswith(deeper)))

    for path in paths:
        if text := below(path):
            return text
    own = main_container(found)
    return below(own[0]) if own else ""


def host(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, paths): the paths that a host's pages have voted for, most votes first."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0, 0.0])

        def out() -> pa.RecordBatch:
            keys, sums = list(votes), list(votes.values())
            votes.clear()
            columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(2)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([round(s[1] * (1 << 20)) for s in sums], pa.int64())], ["host", "path", "votes"])

        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if page and (best := main_container(blocks(page))):
                    votes[name, best[0]][1] += best[1]
            if len(votes) > 50_000:
                yield out()
        yield out()

    votes = pages.select(host(url).alias("host"), F.col(html).cast("string").alias("html")).mapInArrow(run, "host string, path string, votes long")
    sums = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("less"), "path")))
    return sums.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def main_texts(pages: DataFrame, url: str = "url", html: str = "html", page_id: str = "page_id") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    winners = written(host_paths(pages, url, html), "paths")
    narrow = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"), host(url).alias("host"))

    @F.arrow_udf("string")
    def extract(html: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([main_text(blocks(page), ranked or []) if page else "" for page, ranked in zip(html.to_pylist(), paths.to_pylist())], pa.string())

    joined = narrow.join(sized(winners), "host", "left")
    found = joined.select("page_id", "url", extract("html", "paths").alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
