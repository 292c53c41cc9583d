"""Main text of web pages by consensus host paths.

A page is read as a stream of tags.  Containers are named by their path of generalised
tag classes (``body>div.content``; digits in classes become ``#``).  Every page scores
its containers: text outside links, weighed by how paragraph-like it is.  The votes are
summed per host in Spark, the path with the most votes wins the host and climbs to its
article, or to outer containers that add mostly unlinked prose (to the body only for
prose directly in it), and every page is extracted again with that path.  Pages whose host has no winner, or that do not
have the winning path, use their own best container.

Boilerplate inside a container - menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments - is left out by tag, role or class.  Classes are
only names: an element that holds the article, or most of the prose of a page without one,
stays, and so do headers inside the article.

Text: character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined in page order by one line feed.

Defined results: null or empty html, and pages without any text, give the empty text;
a null url is the host of its own group; unclosed and stray tags are tolerated; an
unclosed comment, script, style or tag ends with the page; of elements nested more than
``DEEPEST`` deep all text stays, and their path ends there; repeated rows each get their
text; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import steps, stored
from flowframe.llm.url_filter import host_of

#: A comment, a declaration, or an element whose content is not shown.
SKIPPED = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(script|style|template|svg|iframe|textarea|select)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
#: Start of a tag, and the rest of it with and without regard to quotes.
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
REST = re.compile(r"((?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>")
LOOSE_REST = re.compile(r"([^>]*)>")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers of a path; those further in count as part of the last.
DEEPEST = 64
MATH = frozenset("math mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("body main article section div td center".split())
DROPPED_TAGS = frozenset("head title nav footer aside form button menu dialog fieldset annotation annotation-xml".split())
#: Dropped outside of the elements that hold the article.
OUTSIDE_TAGS = frozenset("header noscript".split())
ARTICLE = frozenset("article main".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: A word of a class or id that names boilerplate; readers' contributions stay out whatever they hold.
COMMENT_WORDS = frozenset("comment comments disqus reply replies".split())
DROPPED_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies "
    "footer gdpr header menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
#: Words before and after which a class tells of the page's layout, as in ``no-sidebar`` and ``reply-free``.
LAYOUT_BEFORE = frozenset("no not has with without hide show is".split())
LAYOUT_AFTER = frozenset("free off on open closed enabled disabled count".split())
#: Blocks of running text, for the climb.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li".split())
#: End tags that a start tag implies.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
PARAGRAPH_ENDERS = frozenset("address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure".split())


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(raw)}


def _dropped(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether tag, role or state drop an element whatever it holds."""
    if tag in DROPPED_TAGS or tag in OUTSIDE_TAGS and not in_article or attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    return ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
            or "display:none" in attributes.get("style", "").replace(" ", "").lower())


def _named(tag: str, attributes: dict[str, str], in_article: bool) -> set[str]:
    """The boilerplate words in an element's classes and id."""
    if tag in ("body", "html", "article", "main"):
        return set()
    found: set[str] = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        for i, w in enumerate(words):
            if w in DROPPED_WORDS and not (i and words[i - 1] in LAYOUT_BEFORE) and not (i + 1 < len(words) and words[i + 1] in LAYOUT_AFTER):
                found.add(w)
    return found - {"header"} if in_article else found


def _step(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted(set(re.sub(r"\d+", "#", attributes.get("class", "").lower()).split()))
    return ".".join([tag, *classes])


class Block:
    __slots__ = ("path", "parts", "linked", "size", "tag", "named")

    def __init__(self, path: tuple[str, ...], tag: str, named: "Named | None") -> None:
        self.path, self.tag, self.named, self.parts, self.linked, self.size = path, tag, named, [], 0, 0


class Named:
    """An open element whose class or id names boilerplate, and the next such one around it."""

    __slots__ = ("outer", "comments", "holds_article", "prose", "kept")

    def __init__(self, outer: "Named | None", comments: bool) -> None:
        self.outer, self.comments, self.holds_article, self.prose, self.kept = outer, comments, False, 0, None

    def chain(self) -> Iterator["Named"]:
        at: Named | None = self
        while at is not None:
            yield at
            at = at.outer


def _without_named(found: list[Block], has_article: bool) -> list[Block]:
    """The blocks that no named element drops.  An element with an article or, on pages
    without one, with most of the unlinked prose is no boilerplate, whatever its name."""
    total = 0
    for b in found:
        prose = max(0, b.size - b.linked) if b.tag in PROSE else 0
        total += prose
        for named in b.named.chain() if b.named else ():
            named.prose += prose
    def kept(b: Block) -> bool:
        for named in b.named.chain() if b.named else ():
            if named.kept is None:
                named.kept = not named.comments and (named.holds_article or not has_article and named.prose * 2 > total)
            if not named.kept:
                return False
        return True
    return [b for b in found if kept(b)]


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, each with the path of its containers; time in proportion to the page."""
    out: list[Block] = []
    # open elements: tag, path of containers, whether dropped, in a link, in an article, innermost named element
    stack: list[tuple[str, tuple[str, ...], bool, bool, bool, Named | None]] = [("", (), False, False, False, None)]
    opened: dict[str, int] = {}
    block: Block | None = None
    has_article = loose = False

    def text(raw: str) -> None:
        nonlocal block
        _, path, dropped, linked, _, named = stack[-1]
        if dropped or not raw:
            return
        shown = html.unescape(raw) if "&" in raw else raw
        if block is None:
            if not shown.strip():
                return
            tag = next((t for t, *_ in reversed(stack) if t not in INLINE), "")
            block = Block(path, tag, named)
            out.append(block)
        block.parts.append(shown)
        n = len(shown.strip())
        block.size += n
        block.linked += n if linked else 0

    def pop(k: int) -> None:
        """Close the elements from the ``k``-th on."""
        for t, *_ in stack[k:]:
            opened[t] -= 1
        del stack[k:]

    def close(tag: str) -> None:
        nonlocal block
        if not opened.get(tag):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == tag:
                if any(t not in INLINE for t, *_ in stack[k:]):
                    block = None
                pop(k)
                return
            if tag in INLINE and stack[k][0] not in INLINE:
                return  # an inline end tag does not leave its block

    at, last = 0, page.rfind(">")
    while True:
        i = page.find("<", at)
        if i < 0:
            text(page[at:])
            break
        skipped = SKIPPED.match(page, i) if i <= last or page.startswith(("<!", "<?"), i) else None
        if skipped:
            text(page[at:i])
            at = skipped.end()
            continue
        start = TAG.match(page, i)
        if not start:  # a bare sign
            text(page[at:i + 1])
            at = i + 1
            continue
        rest = None if loose else REST.match(page, start.end())
        if rest is None:
            # quotes that never close: from here on a tag ends at the next sign, quoted or not
            loose = True
            rest = LOOSE_REST.match(page, start.end()) if i < last else None
        text(page[at:i])
        if rest is None:
            break  # a tag cut off by the end
        at, tag, raw = rest.end(), start[2].lower(), rest[1]
        if start[1]:
            close(tag)
            if tag not in INLINE:
                block = None
            continue
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                if tag == "br" and block is not None:
                    block.parts.append(" ")
                continue
        else:
            block = None
            # a block's start ends an open paragraph and the inline elements in it
            k = len(stack)
            while k > 1 and stack[k - 1][0] in INLINE:
                k -= 1
            if tag in PARAGRAPH_ENDERS and stack[k - 1][0] == "p":
                k -= 1
            ended = CLOSES.get(tag)
            if ended and stack[k - 1][0] in ended:
                k -= 1
            pop(k)
        if tag in VOID or raw.endswith("/"):
            continue
        attributes = _attributes(raw) if raw.strip() else {}
        _, path, dropped, linked, in_article, named = stack[-1]
        if tag in ARTICLE and not dropped:
            has_article = has_article or not (named and any(x.comments for x in named.chain()))
            for around in named.chain() if named else ():
                around.holds_article = True
        words = _named(tag, attributes, in_article)
        if words:
            named = Named(named, not COMMENT_WORDS.isdisjoint(words))
        if tag in CONTAINERS and len(path) < DEEPEST:
            path = (*path, _step(tag, attributes))
        dropped = dropped or _dropped(tag, attributes, in_article)
        stack.append((tag, path, dropped, linked or tag == "a", in_article or tag in ARTICLE, named))
        opened[tag] = opened.get(tag, 0) + 1
    return _without_named(out, has_article)


def votes(found: list[Block]) -> dict[str, float]:
    """Score of every container path of a page: its own paragraphs in full, nested ones by half a level."""
    out: dict[str, float] = {}
    for block in found:
        weight = {"p": 1.0, "h1": 1.0, "blockquote": 1.0, "pre": 1.0}.get(block.tag, 0.5)
        worth = weight * max(0, block.size - 2 * block.linked)
        for up in range(len(block.path), 0, -1):
            key = ">".join(block.path[:up])
            out[key] = out.get(key, 0.0) + worth
            worth *= 0.5
    return {k: v for k, v in out.items() if v > 0}


def best_path(scored: dict[str, float]) -> str | None:
    return min(scored, key=lambda k: (-scored[k], k)) if scored else None


def spans(found: list[Block]) -> dict[str, tuple[int, int, int]]:
    """Characters inside every container path: unlinked prose, all, and unlinked prose directly in it."""
    out: dict[str, tuple[int, int, int]] = {}
    for block in found:
        prose = max(0, block.size - block.linked) if block.tag in PROSE else 0
        for up in range(len(block.path), 0, -1):
            key = ">".join(block.path[:up])
            had = out.get(key, (0, 0, 0))
            out[key] = (had[0] + prose, had[1] + block.size, had[2] + (prose if up == len(block.path) else 0))
    return out


def climb(path: str | None, inside: dict[str, tuple[int, int, int]]) -> str | None:
    """The container of the whole article around the winner ``path``."""
    if path is None:
        return None
    steps, at = path.split(">"), path
    for up in range(len(steps) - 1, 0, -1):
        outer, tag = ">".join(steps[:up]), steps[up - 1].split(".")[0]
        if outer not in inside or at not in inside:
            continue
        extra = inside[outer][1] - inside[at][1]
        prose = inside[outer][2] if tag in ("body", "html") else inside[outer][0] - inside[at][0]
        if tag == "article" or (extra > 0 and prose * 2 >= extra):
            at = outer
    return at


def render(found: list[Block], path: str | None) -> str | None:
    """Text of the blocks inside ``path``; null if the page has none there."""
    if path is None:
        return None
    steps = tuple(path.split(">"))
    inside = [b for b in found if b.path[:len(steps)] == steps]
    if not inside:
        return None
    texts = (SPACE.sub(" ", "".join(b.parts)).strip() for b in inside)
    return "\n".join(t for t in texts if t)


def extract(page: str, path: str | None = None) -> str:
    """Main text of one page by ``path``, or by its own best container."""
    found = blocks(page)
    text = render(found, path)
    if text is None:
        text = render(found, climb(best_path(votes(found)), spans(found)))
    if text is None:
        text = "\n".join(t for t in (SPACE.sub(" ", "".join(b.parts)).strip() for b in found) if t)
    return text


def host_votes(pages: DataFrame, host: str = "host", html_column: str = "html") -> DataFrame:
    """(host, path, votes, prose, size, own) summed over all pages; the last three are :func:`spans`."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in steps(batch, column=1)):
            total: dict[tuple[str, str], tuple[float, int, int, int]] = {}
            for own, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if page:
                    found = blocks(page)
                    worth = votes(found)
                    for path, sizes in spans(found).items():
                        had = total.get((own, path), (0.0, 0, 0, 0))
                        total[own, path] = (had[0] + worth.get(path, 0.0), *(a + b for a, b in zip(had[1:], sizes)))
            sums = [pa.array([v[i] for v in total.values()], pa.float64() if i == 0 else pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()), *sums],
                                             names=["host", "path", "votes", "prose", "size", "own"])

    found = pages.select(host, html_column).mapInArrow(tally, "host string, path string, votes double, prose long, size long, own long")
    return found.groupBy("host", "path").agg(F.sum(F.round("votes", 3)).alias("votes"), *[F.sum(c).alias(c) for c in ("prose", "size", "own")])


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes, ties to the path that sorts first, and its climb."""
    tallies = stored(host_votes(pages))
    best = F.min(F.struct((-F.col("votes")).alias("v"), "path")).alias("best")
    winners = tallies.where("votes > 0").groupBy("host").agg(best).select("host", F.col("best.path").alias("won"))
    steps = F.split("won", ">")
    outer = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), ">"))
    around = winners.withColumn("path", F.explode(outer)).join(tallies, ["host", "path"])
    each = around.groupBy("host", "won").agg(F.collect_list(F.struct("path", "prose", "size", "own")).alias("inside"))

    def rise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [climb(won, {r["path"]: (r["prose"], r["size"], r["own"]) for r in inside})
                     for won, inside in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], names=["host", "path"])

    return each.mapInArrow(rise, "host string, path string")


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html_column: str = "html",
                  salts: int = 16) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``.

    Winning paths are a written table: broadcast only if its real size allows; beyond
    that a hot host is spread over ``salts`` join keys.
    """
    named = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                         F.col(f"`{html_column}`").cast("string").alias("html")).withColumn("host", host_of(F.col("url")))
    winners = stored(winning_paths(named))
    spread = named.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    each = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = spread.join(each, ["host", "salt"], "left").select("html", "page_id", "url", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                texts = [extract(page, path) if page else "" for page, path in zip(part.column(0).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = dict(joined.dtypes)["page_id"]
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")
