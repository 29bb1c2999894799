"""Main text of web pages by two passes over their blocks (operator 3).

A page is cut into blocks at its block-level tags; scripts, styles, forms and source
comments are no blocks. Regions that mark themselves as menus, headers, footers, sidebars,
notices, adverts or reader comments (by tag, role, class or id) hint at what their blocks are.

First pass: a hinted block is boilerplate, and so is one that is mostly links; one with
enough running text and stop words (English, German, French, Spanish) is content; all
others, short or without stop words, are ambiguous. Second pass: an ambiguous block takes the
label of the nearest decided block before and after it, content if they are equally near; a
heading takes that of the text after it. Where no block is decided to be content, as in a
page of a few words, all ambiguous ones are.

``article`` and ``main`` say where the text is. If the blocks in articles hold at least half of the
decided content, what lies outside of them is boilerplate, else the same is asked of ``main``; a
teaser in an article beside a long text does not take its place. Inside of them the flow is
the author's own: links do not make a block boilerplate there, and hinted insertions do
not reach the blocks around them.

Character references are decoded, white space inside a block becomes one space, and
blocks are joined by one line feed. ``br`` is white space.

Cases: a null or empty page has an empty text, as has a page without content; repeated rows
have their text as often as they come; an empty table gives an empty table; a very long
page is read whole, in time that grows with its length. Tags may
be unclosed or wrongly nested; a comment, script or style that never ends reaches to
the end of the page. A ``<`` that starts no tag is text.
"""

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LENGTH_GOOD = 70
STOP_GOOD = 0.2
LINK_BAD = 0.5

# Frequent function words of the four languages.
STOP_WORDS = frozenset(
    """
    the of and to a in is it that was for on are as with his they at be this from have or by one had not but what all
    were when we there can an your which their said if do will each about how up out them then she many some so these
    would other into has more her two like him see time could no make than been its who now did you i he my me our us
    der die das und ist nicht ein eine einen einem einer des dem den zu im in mit auf für von sich auch als an es so
    wie bei oder aber aus nach wird sind war hat nur noch über dass sie er ich wir ihr man durch um am
    le la les de des du un une et est que qui dans pour pas au aux sur par avec il elle ne se ce cette son sa ses nous
    vous ils sont mais ou plus comme on leur en à été être
    el los las del una unos y es no se por con para su al lo como más pero sus ya o este sí porque esta entre cuando
    muy sin sobre también me hasta hay donde quien desde todo nos
    """.split()
)

HARD_TAGS = {"nav", "footer", "aside", "menu", "dialog", "button", "select", "textarea", "fieldset"}
# What is in these is no block at all.
GONE_TAGS = {"form", "head"}
SCOPE_SHARE = 0.5
RAW_TAGS = "script|style|noscript|template|iframe|svg|textarea|title|object|canvas|select"
BLOCK_TAGS = set(
    """
    address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section
    select summary table tbody td textarea tfoot th thead tr ul
    """.split()
)
VOID_TAGS = {"hr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words in class, id or role that mark a region for good, and those that an article inside it overrules.
STRONG_HINT = re.compile(
    r"ads?|ad(vert|sense|sby)\w*|sponsor\w*|promo\w*|aside|side(bar|nav)\w*|complementary|comment(s|list|section|ary)?"
    r"|disqus\w*|respond|reply|replies|related\w*|recommend\w*|newsletter\w*|subscri\w*"
)
WEAK_HINT = re.compile(
    r"nav(bar|igation|list|menu)?|menu\w*|breadcrumbs?|header|masthead|topbar|footer|contentinfo|banner|cookies?\w*"
    r"|consent\w*|gdpr\w*|notices?|notification\w*|alerts?|pop(up|over)\w*|modal|overlay|toolbar|pager|pagination"
    r"|shar(e|ing)|social\w*|widgets?|log(in|out)|sign(in|up)|search(box|form)?|copyright|legal|skip|hidden"
)
# What says that a page has such a region elsewhere.
_MENTION = re.compile(r"\b(has|with|no|without|show|hide)[-_ ]?[a-z0-9]+")

_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW_TAGS})\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/)?(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|</[^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|aria-hidden|style|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    heading: bool
    hinted: bool
    in_main: bool
    in_article: bool


def _mark(name: str, rest: str) -> int:
    """3 for what is no block, 2 for a hint that holds for all inside, 1 for one that an article inside overrules, else 0."""
    if name in GONE_TAGS:
        return 3
    if name in HARD_TAGS:
        return 2
    mark = 1 if name == "header" else 0
    if rest and name not in ("html", "body"):
        for attribute, *values in _ATTRIBUTE.findall(rest):
            value = "".join(values).lower()
            kind = attribute.lower()
            if kind == "hidden" or (kind == "aria-hidden" and value == "true"):
                mark = 2
            elif kind == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    mark = 2
            elif kind in ("class", "id", "role"):
                tokens = _TOKEN.findall(_MENTION.sub(" ", value))
                if any(STRONG_HINT.fullmatch(token) for token in tokens):
                    mark = 2
                elif name not in HEADINGS and any(WEAK_HINT.fullmatch(token) for token in tokens):
                    mark = max(mark, 1)
    return mark


def collapsed(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def blocks(page: str) -> list[Block]:
    """All blocks of a page, with the hints and scopes of the regions around them."""
    found: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # name, mark, scope of the open block-level elements
    text: list[str] = []
    links: list[str] = []
    anchors, heading = 0, False

    def flush() -> None:
        nonlocal heading
        joined = collapsed(text)
        if joined:
            mark, scope = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
            if mark < 3:
                linked = len(collapsed(links))
                found.append(Block(joined, linked, heading, mark > 0, bool(scope & 1), bool(scope & 2)))
        text.clear()
        links.clear()
        heading = False

    def add(part: str) -> None:
        if part:
            text.append(part)
            if anchors:
                links.append(part)

    at, closed = 0, True
    last = page.rfind(">") + 1  # no tag ends later
    for tag in _TAG.finditer(page, 0, last):
        add(page[at : tag.start()])
        at = tag.end()
        closed = tag[0].endswith(">") and not (tag["raw"] and not tag[0].lower().endswith(f"</{tag['raw'].lower()}>"))
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            add(" ")
        elif name == "a":
            anchors = 0 if tag["close"] else 1
            if anchors and links:
                links.append(" ")
        elif name in BLOCK_TAGS:
            flush()
            if tag["close"]:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        del stack[depth:]
                        break
                anchors = 0
            elif name not in VOID_TAGS and not tag["rest"].rstrip().endswith("/"):
                if stack and stack[-1][0] == name and name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                    stack.pop()
                elif stack and stack[-1][0] == "p":
                    stack.pop()
                mark, scope = _mark(name, tag["rest"]), 0
                if stack:
                    outer, scope = stack[-1][1], stack[-1][2]
                    if name in ("article", "main"):
                        outer = outer if outer > 1 else 0
                    elif name == "header" and scope and mark == 1 and not outer:
                        mark = 0  # an article's own header holds its headline
                    mark = max(mark, outer)
                if name in ("article", "main"):
                    scope |= 2 if name == "article" else 1
                    mark = 0 if mark == 1 else mark
                stack.append((name, mark, scope))
                heading = name in HEADINGS
    if closed or at < last:
        add(page[at:].partition("<!--")[0])
    flush()
    return found


def first_pass(block: Block, inside=False) -> bool | None:
    """True for content, False for boilerplate, None for an ambiguous block; ``inside`` for the flow of an article."""
    if block.hinted:
        return False
    if block.linked > LINK_BAD * len(block.text):
        return None if inside else False
    if block.heading or len(block.text) < LENGTH_GOOD:
        return None
    words = _WORD.findall(block.text.lower())
    if words and sum(word in STOP_WORDS for word in words) >= STOP_GOOD * len(words):
        return True
    return None


def scope_of(found: list[Block]) -> list[bool] | None:
    """Which blocks lie where the page says its text is; None if it does not say, or says it of too little."""
    sizes = [len(block.text) if first_pass(block) else 0 for block in found]
    for scope in ([b.in_article for b in found], [b.in_main for b in found]):
        own = [b for b, within in zip(found, scope) if within and not b.hinted]
        held = sum(size for size, within in zip(sizes, scope) if within)
        if own and held >= SCOPE_SHARE * sum(sizes):
            return scope
    return None


def second_pass(found: list[Block], decided: list[bool | None]) -> list[bool]:
    """Ambiguous blocks take the label of the nearest decided ones."""
    if True not in decided:
        return [label is None for label in decided]
    after: list[tuple[int, bool] | None] = [None] * len(found)
    near = None
    for i in range(len(found) - 1, -1, -1):
        near = (i, decided[i]) if decided[i] is not None else near
        after[i] = near
    result, before = [], None
    for i, label in enumerate(decided):
        if label is not None:
            before = (i, label)
            result.append(label)
        elif found[i].heading and after[i]:
            result.append(after[i][1])
        else:
            ends = [(abs(i - at), not value) for at, value in (end for end in (before, after[i]) if end)]
            result.append(not min(ends)[1])
    return result


def labels(found: list[Block]) -> list[bool]:
    scope = scope_of(found)
    if scope is None:
        return second_pass(found, [first_pass(block) for block in found])
    # The flow inside: without what lies outside of it, and without what is hinted in it.
    flow = [i for i, block in enumerate(found) if scope[i] and not block.hinted]
    inside = [found[i] for i in flow]
    kept = dict(zip(flow, second_pass(inside, [first_pass(block, inside=True) for block in inside])))
    return [kept.get(i, False) for i in range(len(found))]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(block.text for block, keep in zip(found, labels(found), strict=True) if keep)


def extract_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(page.as_py()) for page in part.column(2)]
                sizes = pa.array([len(text) for text in texts], pa.int64())
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes],
                    names=["page_id", "url", "text", "n_chars"],
                )

    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return pages.select(*columns).mapInArrow(run, "page_id long, url string, text string, n_chars long")
