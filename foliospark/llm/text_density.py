"""Main text of web pages by composite text density.

Every block of the page has a density, its characters per tag, lowered by the
share of links; the sum of its children's densities finds the subtree with most
running text. The least density on the way from there to the body is the
threshold that other parts must reach to belong to the text as well.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from foliospark.llm.bpe_tree import slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
#: Elements that are never part of the text.
LEFT_OUT = RAW | frozenset("head nav footer aside form button select input svg canvas object audio video map menu dialog datalist".split())
ROOTS = frozenset("html body main article".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Blocks that are text rather than parts of a page: inside the main text their names mean nothing unless they are mostly links.
PASSAGES = frozenset("p li dt dd tr td th caption figcaption blockquote pre address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup summary legend".split())
#: Names of classes and ids that mark menus, headers, footers, sidebars, notices, adverts, forms and comments. They weigh only
#: with blocks other than headings, and inside the main text only with those that aren't running text.
_NAMES = re.compile(
    r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|post|article|user|reader|social|sticky|js|the|google)?[-_]?"
    r"(?:ads?|adverts?|advert[a-z]*ments?|adsense|adsbygoogle|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?|cookiebar|consent|gdpr|notices?|alerts?|notifications?|disclaimer|newsletter|subscribe|subscription|signup|"
    r"popup|modal|overlay|sidebars?|side|widgets?|related|recommended|recommendations|more-?stories|trending|popular|share|sharing|shares|social|follow|comments?|commentlist|discussion|disqus(?:_thread)?|respond|repl(?:y|ies)|"
    r"menus?|nav|navi|navbar|navigation|breadcrumbs?|footers?|headers?|masthead|topbar|toolbar|pagination|pager|login|search|searchform|forms?|skip-?links?|copyright|tags|tagcloud|metadata|byline-share)"
    r"(?:[-_](?:box|area|list|wrap|wrapper|container|content|inner|outer|section|block|bar|banner|links?|menu|message|popup|form|thread|posts?|articles?|unit|slot|top|bottom|left|right|notice|\d+))*",
    re.I,
)
#: Those among them that hold text of others even when it is running text: reader comments, adverts, notices and sidebars.
_FOREIGN = re.compile(
    r"(?:site|page|top|bottom|left|right|post|article|user|reader|js|google)?[-_]?"
    r"(?:ads|adverts?|advert[a-z]*ments?|adsense|adsbygoogle|sponsor(?:ed|s)?|cookies?|cookiebar|consent|gdpr|notices|newsletter|subscribe|signup|popup|sidebars?|comments?|commentlist|disqus(?:_thread)?|respond|repl(?:y|ies)"
    r"|(?:cookie|privacy|legal|site|gdpr|consent)[-_](?:notice|alert|banner))"
    r"(?:[-_](?:box|area|list|wrap|wrapper|container|content|inner|outer|section|block|bar|message|popup|form|thread|posts?|unit|slot|top|bottom|left|right|notice|banner|\d+))*",
    re.I,
)
_COMMENTS = re.compile(r"(?:user|reader|post)?[-_]?(?:comments?|repl(?:y|ies))(?:[-_](?:body|item|content|box|\d+))*", re.I)
_HEADERS = re.compile(r"(?:site|page|main|top|post|article|entry)?[-_]?(?:headers?|masthead)(?:[-_](?:box|wrap|wrapper|container|content|inner|block))*", re.I)
_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
_AFTER_CDATA = re.compile(_TOKEN.pattern.replace(r"<!\[CDATA\[.*?\]\]>|", ""), re.S)
_COMMENT = re.compile("<!--")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WHOLE = re.compile("<(?:article|main)", re.I)
_SPACE = re.compile(r"\s+")
#: Characters outside links from which a block's own text counts as running text.
RUNNING = 40


def is_left_out(name: str, attributes: str, in_article: bool, form: bool) -> bool:
    """``form``: whether this element, if it is a form, is read like any block."""
    if name in ROOTS:
        return False
    if name in LEFT_OUT and not (form and name == "form"):
        return True
    if name == "header":
        return not in_article
    if not attributes or attributes.isspace():
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def names_of(attributes: str) -> list[str]:
    """Classes and ids."""
    if not attributes or attributes.isspace():
        return []
    found = ((key.lower(), value.strip("\"'")) for key, value in _ATTRIBUTE.findall(attributes))
    return [x for key, value in found if key in ("class", "id") for x in value.split()]


def is_named(name: str, attributes: str) -> bool:
    """Whether a block's class or id is one of those names; an ``article`` counts if it is a comment."""
    if name == "article":
        return any(map(_COMMENTS.fullmatch, names_of(attributes)))
    if name not in BLOCKS or name in HEADINGS or name in ROOTS:
        return False
    return any(map(_NAMES.fullmatch, names_of(attributes)))


class Page:
    """Blocks of a page in document order, with counts of characters and tags, in links and overall."""

    def __init__(self, source: str, forms: frozenset[int] | None = frozenset(), names: frozenset[int] | None = frozenset()):
        """``forms`` and ``names``: which forms and which named blocks, each numbered from 0 in page order, are read like other blocks; None for all."""
        self.tag, self.parent = ["html"], [0]
        self.chars, self.link_chars, self.tags, self.link_tags = [0], [0], [0], [0]
        self.own = [0.0]
        self.pieces: list[tuple[int, int, str]] = []  # segment, block, text
        self.forms = 0
        self.form_at: dict[int, int] = {}  # block: number of the form
        self.named = 0
        self.named_at: dict[int, int] = {}  # block: number of the named block
        self.foreign: set[int] = set()  # named blocks that stay out even if they hold running text
        self.headers: set[int] = set()  # blocks named as headers
        self.dropped: list[tuple[int, int]] = []  # number of the named block left out, the block around it
        self._read(source, forms, names)
        for k in range(len(self.tag) - 1, 0, -1):
            up = self.parent[k]
            self.chars[up] += self.chars[k]
            self.link_chars[up] += self.link_chars[k]
            self.tags[up] += self.tags[k] + 1
            self.link_tags[up] += self.link_tags[k]

    def _read(self, source: str, forms: frozenset[int] | None, names: frozenset[int] | None) -> None:
        stack: list[tuple[str, int, bool]] = []  # element, the block that is current after it closes, whether it is left out
        places: dict[str, list[int]] = {}  # element: where it is in the stack, and so for all blocks
        block_places: list[int] = []
        last_tag, last_cdata = source.rfind(">"), source.rfind("]]>")
        block, out, links, articles, segment, at = 0, 0, 0, 0, 0, 0

        def text(piece: str) -> None:
            if "&" in piece:
                piece = html.unescape(piece)
            n = len(_SPACE.sub(" ", piece.strip())) if piece else 0
            self.chars[block] += n
            self.own[block] += 0 if links else n
            if links:
                self.link_chars[block] += n
            self.pieces.append((segment, block, piece))

        def close(depth: int) -> None:
            nonlocal block, out, links, articles, segment
            while len(stack) > depth:
                name, before, left = stack.pop()
                places[name].pop()
                if name in BLOCKS:
                    block_places.pop()
                out -= left
                links -= name == "a"
                articles -= name in ("article", "main")
                if name in BLOCKS:
                    segment += 1
                block = before

        def open_depth(names: tuple[str, ...], stop: frozenset[str]) -> int:
            """Where the innermost open element of those names is, -1 if there is none or one of ``stop`` is inside it."""
            at = max((places[n][-1] for n in names if places.get(n)), default=-1)
            if at >= 0 and stop:
                inner = (block_places[-1] if block_places else -1) if stop is BLOCKS else max((places[n][-1] for n in stop if places.get(n)), default=-1)
                return at if at >= inner else -1
            return at

        size = len(source)
        while at < size:
            token = _COMMENT if at > last_tag else _TOKEN if at < last_cdata else _AFTER_CDATA
            found = token.search(source, at)
            if found is None:
                if not out:
                    text(source[at:])
                break
            if found.start() > at and not out:
                text(source[at : found.start()])
            if token is _COMMENT:  # never closed
                break
            at = found.end()
            name = found[2] or found[5]
            if name is None:
                continue
            name, ending, attributes = name.lower(), found[1] or found[4], found[3] if found[2] else found[6]
            if ending:
                depth = open_depth((name,), frozenset() if name in BLOCKS else BLOCKS)
                if depth >= 0:
                    close(depth)
                continue
            if name == "br":
                if not out:
                    self.tags[block] += 1
                    self.pieces.append((segment, block, " "))
                continue
            if name in BLOCKS:
                if (depth := open_depth(("p",), _P_SCOPE)) >= 0:
                    close(depth)
                same, stop = _CLOSES.get(name, ((), frozenset()))
                if same and (depth := open_depth(same, stop)) >= 0:
                    close(depth)
            if name in VOID:
                if not out:
                    self.tags[block] += 1
                    segment += name == "hr"
                continue
            left = is_left_out(name, attributes, articles > 0, forms is None or self.forms in forms)
            self.forms += name == "form"
            named = is_named(name, attributes)
            if named:
                if names is not None and self.named not in names:
                    if not out and not left and (self.tag[block] not in ("body", "html") or name == "section" or name in PASSAGES):
                        self.dropped.append((self.named, block))
                    left = True
                self.named += 1
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else size
                continue
            places.setdefault(name, []).append(len(stack))
            if name in BLOCKS:
                block_places.append(len(stack))
            stack.append((name, block, left))
            out += left
            if out:
                if name in BLOCKS:
                    segment += 1
                links += name == "a"
                articles += name in ("article", "main")
                continue
            links += name == "a"
            articles += name in ("article", "main")
            if name in BLOCKS:
                segment += 1
                self.tag.append(name)
                self.parent.append(block)
                for counts in (self.chars, self.link_chars, self.tags, self.link_tags, self.own):
                    counts.append(0)
                block = len(self.tag) - 1
                if name == "form":
                    self.form_at[block] = self.forms - 1
                if named:
                    self.named_at[block] = self.named - 1
                    if name not in PASSAGES and any(map((_COMMENTS if name == "article" else _FOREIGN).fullmatch, names_of(attributes))):
                        self.foreign.add(block)
                    elif any(map(_HEADERS.fullmatch, names_of(attributes))):
                        self.headers.add(block)
            else:
                self.tags[block] += 1
                self.link_tags[block] += name == "a"

    def last(self) -> list[int]:
        """Last block of each subtree: blocks of a subtree are neighbours."""
        last = list(range(len(self.tag)))
        for k in range(len(last) - 1, 0, -1):
            last[self.parent[k]] = max(last[self.parent[k]], last[k])
        return last

    def running(self) -> list[int]:
        """Characters of running text of each subtree."""
        found = [int(own) if own >= RUNNING else 0 for own in self.own]
        for k in range(len(found) - 1, 0, -1):
            found[self.parent[k]] += found[k]
        return found

    def content_forms(self) -> frozenset[int]:
        """Forms that wrap content: an article or main element, or mostly running text that is at least a third of the page's."""
        running, last = self.running(), self.last()
        return frozenset(
            number
            for k, number in self.form_at.items()
            if any(self.tag[j] in ("article", "main") and self.chars[j] for j in range(k + 1, last[k] + 1)) or 2 * running[k] >= self.chars[k] > 0 and 3 * running[k] >= running[0]
        )

    def content_names(self) -> frozenset[int]:
        """Named blocks that can be part of a text: mostly running text, passages that aren't mostly links, and headers that hold a title.

        Comments, adverts, notices and sidebars can't be, unless they wrap an article or main element.
        """
        running, last = self.running(), self.last()
        wraps = self.wrapping()
        titled = [0] * (len(self.tag) + 1)  # titles before each block
        for k, name in enumerate(self.tag):
            titled[k + 1] = titled[k] + (name in ("h1", "h2") and self.chars[k] > 0)

        def can(k: int) -> bool:
            if self.named_at[k] in wraps:
                return True
            if k in self.foreign or not self.chars[k] or 2 * self.link_chars[k] >= self.chars[k]:
                return False
            return self.tag[k] in PASSAGES or 2 * running[k] >= self.chars[k] or k in self.headers and titled[last[k] + 1] > titled[k + 1]

        return frozenset(number for k, number in self.named_at.items() if can(k))

    def wrapping(self) -> frozenset[int]:
        """Named blocks with an article or main element of the page in them."""
        last = self.last()
        wholes = self.main_articles(last)
        return frozenset(number for k, number in self.named_at.items() if any(k < a <= last[k] for a in wholes))

    def main_articles(self, last: list[int]) -> list[int]:
        """Outermost articles (main elements, where there are none) that hold running text and aren't mostly links; only those with a title, if any has one."""
        running = self.running()
        for name in ("article", "main"):
            found, end = [], -1
            for k in range(len(self.tag)):
                if self.tag[k] == name and k > end and k not in self.foreign and running[k] and 2 * self.link_chars[k] < self.chars[k]:
                    found.append(k)
                    end = last[k]
            if found:
                return [k for k in found if any(self.tag[j] == "h1" and self.chars[j] for j in range(k, last[k] + 1))] or found
        return []

    def densities(self) -> list[float]:
        """Characters per tag, times a logarithm that falls as links take a larger share of characters and tags."""
        top = max((k for k in range(len(self.tag)) if self.tag[k] == "body"), default=0, key=lambda k: self.chars[k])
        share = self.link_chars[top] / max(1, self.chars[top])
        out = []
        for c, lc, t, lt in zip(self.chars, self.link_chars, self.tags, self.link_tags):
            if not c:
                out.append(0.0)
                continue
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            inside = (c / max(1, lc)) * (max(1, t) / max(1, lt))
            out.append(c / max(1, t) * math.log(inside, base) if base > 1.0000001 and inside > 0 else c / max(1, t) * math.log(max(inside, 1.0) + 1))
        return out

    def chosen(self) -> list[bool]:
        """Which blocks belong to the main text."""
        n = len(self.tag)
        density = self.densities()
        total = [own / 2 for own in self.own]
        for k in range(n - 1, 0, -1):
            total[self.parent[k]] += density[k]
        best = max(range(n), key=lambda k: total[k])
        threshold, k = density[best], best
        while self.tag[k] not in ("body", "html"):
            threshold = min(threshold, density[k])
            k = self.parent[k]
        last = self.last()
        top_total, top_at = total[:], list(range(n))
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            if top_total[k] > top_total[up] or top_total[k] == top_total[up] and top_at[up] != up:
                top_total[up], top_at[up] = top_total[k], top_at[k]
        marked = [False] * n
        for k in range(n):
            if k == 0 or self.tag[k] in ("body", "html") or density[k] >= threshold and (marked[self.parent[k]] or self.tag[self.parent[k]] in ("body", "html") or density[self.parent[k]] >= threshold):
                if self.chars[k]:
                    marked[top_at[k]] = True
        articles = [k for k in range(n) if self.tag[k] == "article" and self.chars[k]] or [k for k in range(n) if self.tag[k] == "main" and self.chars[k]]
        def spread(take: list[bool]) -> None:
            """Takes the subtrees of the blocks taken."""
            for k in range(1, n):
                take[k] = take[k] or take[self.parent[k]]

        take = [False] * n
        only = self.main_articles(last)  # what is outside them never beats them
        if only and not any(marked[k] and any(a <= k <= last[a] or k <= a <= last[k] for a in only) for k in range(n)):
            marked = [k in only for k in range(n)]
        for k in [k for k in range(n) if marked[k]]:
            around = [a for a in articles if a <= k <= last[a]]
            inside = [a for a in articles if k < a <= last[k]]
            if around:
                roots = around[:1]
            elif inside and 2 * sum(self.chars[a] for a in inside if not any(b < a <= last[b] for b in inside)) >= self.chars[k]:
                roots = inside
            else:
                roots = [k]
            if only:
                roots = [a for a in only if any(a <= r <= last[a] or r <= a <= last[r] for r in roots)]
            for r in roots:
                take[r] = True
        spread(take)
        if not articles:  # a parent most of whose text is taken is taken whole
            got = [0] * n
            direct = self.chars[:]
            for k in range(n - 1, 0, -1):
                direct[self.parent[k]] -= self.chars[k]
            for k in range(n - 1, -1, -1):
                got[k] += direct[k] if take[k] else 0
                if not take[k] and self.tag[k] not in ("body", "html") and 2 * got[k] >= self.chars[k] > 0 and 2 * self.link_chars[k] < self.chars[k]:
                    take[k] = True
                    got[k] = self.chars[k]
                if k:
                    got[self.parent[k]] += got[k]
            spread(take)
        return take

    def text(self) -> str:
        if not self.chars[0]:
            return ""
        take = self.chosen()
        blocks: list[list[str]] = []
        now = None
        for segment, block, piece in self.pieces:
            if take[block]:
                if segment != now:
                    blocks.append([])
                    now = segment
                blocks[-1].append(piece)
        joined = (_SPACE.sub(" ", "".join(b)).strip() for b in blocks)
        return "\n\n".join(b for b in joined if b)


_P_SCOPE = frozenset("table td th caption button object".split())
_LISTS, _TABLE = frozenset("ul ol menu dir table td th".split()), frozenset(("table",))
#: Open elements that a new element closes, and those that shield them.
_CLOSES = {
    "li": (("li",), _LISTS),
    "dt": (("dt", "dd"), frozenset(("dl", "table"))),
    "dd": (("dt", "dd"), frozenset(("dl", "table"))),
    "tr": (("tr",), _TABLE),
    "td": (("td", "th"), frozenset(("tr", "table"))),
    "th": (("td", "th"), frozenset(("tr", "table"))),
    "option": (("option",), frozenset(("select",))),
}


def main_text(source: str | None) -> str:
    """The main text: blocks in page order, joined by an empty line. Null and empty pages give an empty text."""
    if not source:
        return ""
    page = Page(source)
    forms = Page(source, None).content_forms() if page.forms else frozenset()
    page = Page(source, forms) if forms else page
    if page.named and not any(x in ("article", "main") for x in page.tag) and _WHOLE.search(source):  # a named block may wrap the article
        wraps = Page(source, forms, None).wrapping()
        page = Page(source, forms, wraps) if wraps else page
    if page.dropped:  # those inside the main text that hold text themselves belong to it
        can, take = Page(source, forms, None).content_names(), page.chosen()
        inside = {number for number, block in page.dropped if number in can and take[block] and page.chars[block]}
        if inside:
            page = Page(source, forms, _with_inner(source, forms, frozenset(inside), can))
    found = page.text()
    if not found and page.forms:  # pages that are a form as a whole
        found = Page(source, None).text()
    return found


def _with_inner(source: str, forms: frozenset[int], inside: frozenset[int], can: frozenset[int]) -> frozenset[int]:
    """Those named blocks, and the ones among ``can`` that lie in them through such blocks only."""
    page = Page(source, forms, can)
    chosen: set[int] = set()
    holds = [False] * len(page.tag)
    for k in range(len(page.tag)):  # parents come first
        number = page.named_at.get(k)
        holds[k] = number in inside or k > 0 and holds[page.parent[k]]
        if number is not None and holds[k]:
            chosen.add(number)
    return frozenset(chosen)


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """Adds text (empty if there is none) and n_chars, its code points, and drops the source.

    Pages are read whole and each by itself, so nothing is shuffled; columns of
    the added names are replaced, others stay. Malformed markup is read as far
    as it can be: unclosed elements end with their parent.
    """
    pages = pages.drop("text", "n_chars")
    keep = [f for f in pages.schema.fields if f.name != source]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                texts = [main_text(t) for t in part.column(source).to_pylist()]
                new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), *new], [*(f.name for f in keep), "text", "n_chars"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return pages.mapInArrow(read, f"{schema}, text string, n_chars long")
