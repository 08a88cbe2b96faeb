"""Main text of web pages: site templates found by counting, the rest by what elements mean."""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import filled, materialize, small_batches, unfilled

# Names of HTML elements by what they mean.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu"
    " nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th caption figcaption".split())
NOT_TEXT = frozenset(
    "head script style noscript template svg canvas iframe object embed audio video map"
    " button select option datalist textarea input form nav menu aside footer dialog search"
    " noembed noframes xmp title".split()
)
NOT_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split()
)
NOT_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion"
    " banner cookie cookies consent gdpr notice notices newsletter subscribe subscription signup"
    " sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer"
    " header masthead topbar toolbar share sharing social related recommended recommendations"
    " popup modal overlay comment comments commentlist disqus respond replies widget widgets"
    " toc skip login".split()
)
#: Words that turn a class into one of what holds such a thing, or of something else.
NAMES_OF_MORE = frozenset("has have with without no not non and enabled disabled content work works".split())
HEADER_NAMES = frozenset({"header", "masthead"})
HEADLINE_NAMES = frozenset({"article", "post", "entry", "story", "title"})
COMMENT_NAMES = frozenset({"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies"})
CLOSED_BY = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "option": frozenset({"option"}),
}
CLOSABLE = frozenset({"p"}).union(*CLOSED_BY.values())
ARTICLES = frozenset({"article", "main"})
FRAMES = ARTICLES | {"html", "body"}
#: Words outside of links from which on a container holds prose: inside an article, and anywhere.
PROSE, LONG_PROSE = 10, 50
INLINE_SCOPES = frozenset("table ul ol dl select button object".split())

# A tag ends before the next one begins, and nothing taken is given back, so a page is read once.
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<![^<>]*+>|<\?[^<>]*+>"
    r"|<(/?)([A-Za-z][^\s/<>]*+)([^<>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^<>\"']*+)*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)


class Element:
    """A node of a page's tree; ``parts`` holds texts and elements in page order."""

    __slots__ = ("attributes", "letters", "mark", "name", "parts", "words")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.attributes, self.parts, self.mark = name, attributes, [], 0
        self.letters = self.words = 0


class _Open:
    """The elements that are open, with what is needed to close any of them without looking through all."""

    def __init__(self, root: Element):
        self.stack = [root]
        self.counts: Counter[str] = Counter()
        # Per open block, how many inline elements of a name are open in it.
        self.inline: list[Counter[str]] = [Counter()]
        # Per open element, where the paragraphs and items are that a new block may close.
        self.closable: list[dict[str, int]] = [{}]

    def push(self, element: Element) -> None:
        name, depth = element.name, len(self.stack)
        self.stack.append(element)
        self.counts[name] += 1
        before = self.closable[-1]
        if name in INLINE_SCOPES or name in BLOCKS - TEXT_BLOCKS:
            before = {}
        self.closable.append({**before, name: depth} if name in CLOSABLE else before)
        if name in BLOCKS:
            self.inline.append(Counter())
        else:
            self.inline[-1][name] += 1

    def pop_from(self, depth: int) -> None:
        while len(self.stack) > depth:
            name = self.stack.pop().name
            self.closable.pop()
            self.counts[name] -= 1
            if name in BLOCKS:
                self.inline.pop()
            else:
                self.inline[-1][name] -= 1

    def end(self, name: str) -> None:
        """An end tag; an inline one does not reach beyond its block, and one without a start is ignored."""
        if not (self.counts[name] if name in BLOCKS else self.inline[-1][name]):
            return
        depth = len(self.stack) - 1
        while self.stack[depth].name != name:
            depth -= 1
        self.pop_from(depth)

    def close_for(self, name: str) -> None:
        """Ends the paragraph or list item that a new block cannot stand in."""
        reach = self.closable[-1]
        depth = max((reach.get(c, 0) for c in CLOSED_BY.get(name, frozenset()) | {"p"}), default=0)
        if depth:
            self.pop_from(depth)


def parse(page: str) -> Element:
    """A tree of any text: tags that never close end with their parent, stray ends are ignored.

    Every tag takes a bounded number of steps, besides those that close elements.
    """
    root = Element("#root")
    opened = _Open(root)
    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        if token is None:
            opened.stack[-1].parts.append(page[at:])
            break
        if token.start() > at:
            opened.stack[-1].parts.append(page[at : token.start()])
        at = token.end()
        name = (token.group(2) or "").lower()
        if not name:
            continue
        if token.group(1):
            opened.end(name)
            continue
        if name in BLOCKS:
            opened.close_for(name)
        element = Element(name, token.group(3))
        opened.stack[-1].parts.append(element)
        if name in RAW:
            at = _raw_end(page, name, at)
        elif name not in VOID and not token.group(3).endswith("/"):
            opened.push(element)
    return root


def _raw_end(page: str, name: str, at: int) -> int:
    close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^<>]*+>", re.I).search(page, at)
    return close.end() if close else len(page)


def _elements(root: Element) -> list[Element]:
    """All elements below one, each before those inside it. No walk here recurses: pages may be deep."""
    found, stack = [], [root]
    while stack:
        inside = [part for part in stack.pop().parts if not isinstance(part, str)]
        found.extend(inside)
        stack.extend(inside)
    return found


def hash_subtrees(root: Element) -> None:
    """Marks every block element with the hash of its whole subtree."""
    digests = {}
    for element in reversed(_elements(root)):
        digest = hashlib.blake2b(digest_size=8)
        digest.update(f"<{element.name}{element.attributes}>".encode("utf-8", "surrogatepass"))
        for part in element.parts:
            if isinstance(part, str):
                digest.update(" ".join(part.split()).encode("utf-8", "surrogatepass"))
            else:
                digest.update(digests.pop(id(part)))
        digests[id(element)] = value = digest.digest()
        if element.name in BLOCKS:
            element.mark = int.from_bytes(value, "little", signed=True)


def template_marks(root: Element) -> list[int]:
    """The hashes of all subtrees that may be a site's template, each once.

    Paragraphs and the like inside an article cannot, nor can the frames of a page. What lies
    inside an element that goes by its own name or class needs no hash of its own.
    """
    hash_subtrees(root)
    found, stack = set(), [(root, False)]
    while stack:
        element, in_article = stack.pop()
        for part in element.parts:
            if isinstance(part, str):
                continue
            if part.name in BLOCKS and not _stays(part, in_article):
                found.add(part.mark)
            if not is_boilerplate(part, in_article):
                stack.append((part, in_article or part.name in ARTICLES))
    return sorted(found)


def _stays(element: Element, in_article: bool) -> bool:
    """Whether an element is kept even if it recurs: authors repeat sentences, too."""
    return element.name in FRAMES or (in_article and element.name in TEXT_BLOCKS)


def _names(element: Element) -> tuple[list[set[str]], str, bool]:
    """The words of each class and id, the role, and whether the element is hidden."""
    names, role, hidden = [], "", False
    for match in _ATTRIBUTE.finditer(element.attributes):
        key = match.group(1).lower()
        value = next((g for g in match.groups()[1:] if g is not None), "").lower()
        if key in ("class", "id"):
            names += [set(re.split(r"[^a-z]+", one)) for one in value.split()]
        elif key == "role":
            role = value.strip()
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            hidden = True
    return names, role, hidden


def _is_named(words: set[str], in_article: bool) -> bool:
    """Whether a class or id says that an element is no part of an article.

    One that says that it has or goes with such a thing does not, nor does a header in an article
    or of one.
    """
    if not NAMES_OF_MORE.isdisjoint(words):
        return False
    found = words & NOT_TEXT_NAMES
    if in_article or not HEADLINE_NAMES.isdisjoint(words):
        found -= HEADER_NAMES
    return bool(found)


def is_boilerplate(element: Element, in_article: bool) -> bool:
    """Whether an element by its own name, role, class or id is no part of an article.

    An article that goes by the name of a comment is one.
    """
    if element.name in NOT_TEXT or (element.name == "header" and not in_article):
        return True
    if not element.attributes:
        return False
    names, role, hidden = _names(element)
    if element.name in FRAMES:
        return element.name == "article" and any(
            words & COMMENT_NAMES and NAMES_OF_MORE.isdisjoint(words) for words in names
        )
    return hidden or role in NOT_TEXT_ROLES or any(_is_named(words, in_article) for words in names)


def _measure(root: Element) -> None:
    """Gives every element its letters, and its words outside of links, boilerplate left out."""
    order, stack = [], [(root, False)]
    while stack:
        element, in_article = stack.pop()
        order.append(element)
        stack.extend(
            (part, in_article or part.name in ARTICLES)
            for part in element.parts
            if not isinstance(part, str) and not is_boilerplate(part, in_article)
        )
    for element in reversed(order):
        element.letters = element.words = 0
        for part in element.parts:
            if isinstance(part, str):
                words = part.split()
                element.letters += sum(map(len, words))
                element.words += len(words)
            else:
                element.letters += part.letters
                element.words += part.words
        if element.name == "a":
            element.words = 0


def _prune(
    root: Element, templates: frozenset[int], usual: frozenset[int]
) -> list[tuple[bool, int, Element, int, Element]]:
    """Deletes site templates and boilerplate below an element.

    Containers in an article that hold prose stay, as does one with most of the page's text, unless
    it is ``usual`` on the site and has little prose. Gives the templates deleted: whether inside
    an article, letters, parent, place, element.
    """
    if templates:
        _measure(root)
    deleted, stack = [], [(root, False)]
    while stack:
        element, in_article = stack.pop()
        kept = []
        for part in element.parts:
            if not isinstance(part, str):
                if is_boilerplate(part, in_article):
                    kept.append(" ")
                    continue
                if part.mark in templates and not _stays(part, in_article):
                    prose = in_article and part.words >= PROSE
                    few = part.mark not in usual or part.words >= LONG_PROSE
                    if not prose and not (few and 2 * part.letters > root.letters):
                        deleted.append((in_article, part.letters, element, len(kept), part))
                        kept.append(" ")
                        continue
                stack.append((part, in_article or part.name in ARTICLES))
            kept.append(part)
        element.parts = kept
    return deleted


def _articles(root: Element) -> list[Element]:
    found, stack = [], [root]
    while stack:
        element = stack.pop()
        if element.name in ARTICLES:
            found.append(element)
        else:
            stack.extend(part for part in reversed(element.parts) if not isinstance(part, str))
    return found


def _blocks(element: Element, blocks: list[list[str]]) -> None:
    stack = [(iter(element.parts), False)]
    while stack:
        parts, block = stack[-1]
        part = next(parts, None)
        if part is None:
            stack.pop()
            if block:
                blocks.append([])
        elif isinstance(part, str):
            blocks[-1].append(part)
        elif part.name == "br":
            blocks[-1].append(" ")
        else:
            block = part.name in BLOCKS
            if block:
                blocks.append([])
            stack.append((iter(part.parts), block))


def main_text(
    root: Element, templates: frozenset[int] = frozenset(), usual: frozenset[int] | None = None
) -> str:
    """The text that is left of a parsed page; the tree must carry hashes for templates.

    ``usual`` are those of the templates that most pages of the site have; all, if not given. Where
    nothing is left of a page, it is taken to be a copy, and the largest template is its text.
    """
    deleted = _prune(root, templates, templates if usual is None else usual)
    text = _text(root)
    if not text and deleted:
        _, letters, parent, place, element = max(deleted, key=lambda x: x[:2])
        if letters:
            _prune(element, frozenset(), frozenset())
            parent.parts[place] = element
            text = _text(root)
    return text


def _text(root: Element) -> str:
    blocks: list[list[str]] = [[]]
    for element in _articles(root) or [root]:
        blocks.append([])
        _blocks(element, blocks)
    texts = (" ".join(entities.unescape("".join(block)).split()) for block in blocks)
    return "\n".join(text for text in texts if text)


def extract_main_text(
    pages: DataFrame, min_pages: int = 5, min_share: float = 0.1, usual_share: float = 0.5
) -> DataFrame:
    """The main text of every page, after the templates of its site are deleted.

    Adds ``text`` and ``n_chars`` to page_id and url. Every block element is hashed with all below
    it; hashes are counted per host, once a page, pages with equal html as one; subtrees on
    ``min_pages`` or more pages of a host that are at least ``min_share`` of its pages are its
    templates. They go, but for containers that hold prose inside ``article`` or ``main``, or most
    of a page's text (those on ``usual_share`` of the pages only with 50 words of prose), and
    nothing goes that leaves no text at all. So does what its own element, role, class or id marks as menu,
    header, footer, sidebar, notice, advert, form, script, style or comment. If the rest has
    ``article`` or ``main`` elements, they alone count. Counts combine before the shuffle, and each
    page gets only its own templates back, so neither a host with a third of all pages nor one with
    countless templates lands in one task.

    A null or empty html gives an empty text, as does a page without any. A null url belongs to no
    host's count but its own (empty) host. Repeated page_ids are pages of their own. Broken markup
    is read as far as it goes. An empty table gives no rows.
    """

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [template_marks(parse(html or "")) for html in batch.html]
            marks = pd.Series(found, index=batch.index, dtype="object")
            yield batch[["_page", "_host", "_content"]].assign(_marks=marks)

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for html, templates, some in zip(batch.html, batch["_templates"], batch["_usual"], strict=True):
                known = frozenset(() if templates is None else map(int, templates))
                usual = frozenset(() if some is None else map(int, some))
                root = parse(html or "")
                if known:
                    hash_subtrees(root)
                found.append(main_text(root, known, usual))
            yield pd.DataFrame(
                {
                    "page_id": batch.page_id.to_numpy(),
                    "url": batch.url.to_numpy(),
                    "text": pd.Series(found, dtype="object"),
                    "n_chars": [len(text) for text in found],
                }
            )

    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/?#]*)", 1))
    # A page is told apart by all it holds, so the two readings need no row numbers that agree.
    own = F.xxhash64("page_id", "url", "html")
    rows = pages.select("page_id", "url", "html").withColumns(
        {"_page": own, "_host": host, "page_id": filled("page_id")}
    )
    content = F.xxhash64("html").alias("_content")
    marks = rows.select("_page", "_host", content, "html").mapInPandas(
        hashes, "_page bigint, _host string, _content bigint, _marks array<bigint>"
    )
    marks = materialize(marks.withColumn("_row", F.monotonically_increasing_id()), "marks")
    # Of pages with equal html one counts.
    firsts = marks.groupBy("_host", "_content").agg(F.min("_row").alias("_row"))
    sizes = firsts.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    counted = marks.join(firsts.select("_row"), "_row", "left_semi")
    recurring = (
        counted.select("_host", F.explode("_marks").alias("_mark"))
        .groupBy("_host", "_mark")
        .count()
        .where(F.col("count") >= min_pages)
        .join(sizes, "_host")
        .where(F.col("count") >= F.col("_pages") * F.lit(min_share))
        .select("_host", "_mark", (F.col("count") >= F.col("_pages") * F.lit(usual_share)).alias("_most"))
    )
    # The templates of one page, at most as many as it has elements.
    known = (
        marks.select("_page", "_host", F.explode("_marks").alias("_mark"))
        .join(recurring, ["_host", "_mark"])
        .groupBy("_page")
        .agg(
            F.collect_set("_mark").alias("_templates"),
            F.collect_set(F.when(F.col("_most"), F.col("_mark"))).alias("_usual"),
        )
    )
    joined = rows.join(known, "_page", "left").select("page_id", "url", "html", "_templates", "_usual")
    found = joined.mapInPandas(texts, "page_id bigint, url string, text string, n_chars bigint")
    return found.withColumn("page_id", unfilled("page_id"))
