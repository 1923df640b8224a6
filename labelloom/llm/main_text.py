"""Main text of web pages by the distribution of text over line blocks.

A page is stripped to lines, one per block of the layout. What is no article by its markup
(menus, forms, adverts, comments, ...) becomes empty lines. Text lengths are summed over
windows of neighbouring lines. From the first and the last window that reach the threshold the
article goes on, back to the surge point and ahead to the dive point, for as long as the sums
are not zero, so short blocks at either end of it stay. Lines that are mostly links weigh
nothing. Where a page marks its article, only lines inside it weigh anything, and the surge and
dive points are looked for among them: a list of links before or behind the text is no part of it
there either. A form that holds an article, or most of a page's text, only wraps it.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelloom.llm.columns import append_columns

# Names of HTML elements and of page parts, fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
) | set(
    "math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
IN_HEAD = set("base link meta noscript script style template title".split())
DROPPED = set(
    "annotation annotation-xml applet aside audio button canvas datalist dialog embed footer frameset head iframe "
    "input menu nav noframes noscript object option script select style svg template textarea title video".split()
)
DROPPED_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
DROPPED_PARTS = set(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disclaimer disqus dropdown footer form login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination popup promo promotion related "
    "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription "
    "toolbar widget widgets".split()
)
# Words that only place or count a part: with them a name of a part stays one.
LAYOUT_WORDS = set(
    "aside area article bar blog block body bottom box btn button buttons center col column container content desktop "
    "entry fb fixed floating global google group header holder icon icons inline inner item items js left link links "
    "list main mobile outer page panel post posts primary right row secondary section site slot sticky text thread "
    "title top unit wp wrap wrapper".split()
)
# Inside a marked article: whole names that are no text of it, and roles.
ARTICLE_DROPPED_PARTS = set(
    "ad ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper adbox ads adslot advert advertisement advertisements "
    "adverts breadcrumb breadcrumbs comment comment-form comment-list comment-respond comments comments-area "
    "comments-list comments-section cookie-banner cookie-notice disqus disqus-thread menu nav navbar newsletter "
    "newsletter-signup pager pagination popup post-comments post-navigation promo related related-articles "
    "related-posts replies share share-buttons share-links sidebar signup social-links social-share sponsor sponsored "
    "subscribe toolbar widget widgets".split()
)
ARTICLE_DROPPED_ROLES = DROPPED_ROLES - {"alert", "form"}
MARKED_ARTICLE = {"article", "main"}
FORM_LABELS = {"label", "legend"}
# The ids of these name what their text is about.
HEADED = set("h1 h2 h3 h4 h5 h6 section".split())
CLOSES_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)

_NAME = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _words(name: str) -> list[str]:
    return _NAME.findall(_CAMEL.sub("-", name).lower())


def _is_part(name: str) -> bool:
    """Whether a class or id names a part to drop by its first or last word, its others known too."""
    words = _words(name)
    if not words or words[0] in {"has", "is", "no", "non", "with", "without"}:
        return False
    letters = [w for w in words if w.isalpha()]
    if not letters or not (letters[0] in DROPPED_PARTS or letters[-1] in DROPPED_PARTS):
        return False
    return all(len(w) == 1 or w in DROPPED_PARTS or w in LAYOUT_WORDS for w in letters)


def _is_whole_part(name: str) -> bool:
    """Whether a class or id is, as a whole, the name of a part no article has."""
    return "-".join(_words(name)) in ARTICLE_DROPPED_PARTS


class _Lines(HTMLParser):
    """The lines of a page: text, letters that are links, and whether in a marked article."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool]] = []  # tag, dropped, marked as the article
        self.places: dict[str, list[int]] = {}  # where each tag is open, the innermost last
        self.dropped = self.marked = self.links = 0
        self.lines: list[tuple[str, int, bool, int]] = []  # the last is the form a line is in, 0 for none
        self.forms = self.form = 0
        self.wrapping: set[int] = set()
        self.text: list[str] = []
        self.linked = 0

    def _end_line(self, gap: bool = False) -> None:
        text = " ".join("".join(self.text).split())
        if text or gap:
            self.lines.append((text, self.linked, self.marked > 0, self.form))
        self.text, self.linked = [], 0

    def _pop(self, count: int) -> None:
        for _ in range(count):
            tag, dropped, marked = self.open.pop()
            self.places[tag].pop()
            self.dropped -= dropped
            self.marked -= marked
            self.links -= tag == "a"
            if tag == "form" and not self.places["form"]:
                self.form = 0

    def _close_to(self, tag: str, stop: set[str]) -> None:
        """Closes the innermost such tag and what is open in it, if no tag of stop is between."""
        at = self._innermost(tag)
        if at >= 0 and all(self._innermost(name) < at for name in stop if name != tag):
            self._pop(len(self.open) - at)

    def _innermost(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _is_dropped(self, tag: str, attributes: dict[str, str]) -> bool:
        if tag in DROPPED or (self.form and tag in FORM_LABELS):
            return True
        is_part = _is_whole_part if self.marked else _is_part
        classes = attributes.get("class", "").split()
        if tag in {"html", "body", *MARKED_ARTICLE}:
            return tag == "article" and any(map(is_part, classes))
        roles = ARTICLE_DROPPED_ROLES if self.marked else DROPPED_ROLES
        if attributes.get("role", "").lower() in roles or "hidden" in attributes:
            return True
        if attributes.get("aria-hidden", "").lower() == "true" or re.search(
            r"display\s*:\s*none", attributes.get("style", ""), re.IGNORECASE
        ):
            return True
        if tag == "form":
            return False
        own_id, names = attributes.get("id", ""), classes
        if tag not in HEADED and "section" not in classes:
            names = [*classes, own_id]
        elif not self.marked and _is_whole_part(own_id):
            return True
        if any(map(is_part, names)):
            return True
        # A page's header is no part of its article, an article's own header is.
        head = tag == "header" or any(_NAME.findall(n.lower())[-1:] == ["header"] for n in names)
        return head and not self.marked

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD and self.places.get("head"):
            self._close_to("head", set())
        if tag in CLOSES_PARAGRAPH:
            self._close_to("p", {"button", "table", "td", "th", "div", "li", "article", "section", "aside"})
        elif tag == "li":
            self._close_to("li", {"ul", "ol", "menu"})
        elif tag in {"option", "tr", "td", "th", "dt", "dd"}:
            self._close_to(tag, {"select", "table", "dl"} | ({"tr"} if tag in {"td", "th"} else set()))
        if tag not in INLINE and not self.dropped:
            self._end_line()
        if tag in VOID:
            return
        attributes = {k: v or "" for k, v in attrs}
        dropped = self._is_dropped(tag, attributes)
        marked = tag in MARKED_ARTICLE or attributes.get("itemprop", "").lower() == "articlebody" or attributes.get(
            "role", ""
        ).lower() in {"main", "article"}
        if dropped and not self.dropped:
            self._end_line(gap=True)
        if tag == "form" and not self.form:
            self.forms += 1
            self.form = self.forms
        if marked and not self.marked and not dropped and not self.dropped and self.form:
            self.wrapping.add(self.form)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, dropped, marked))
        self.dropped += dropped
        self.marked += marked
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE and not self.dropped:
            self._end_line()
        self._close_to(tag, set())

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.text.append(data)
            if self.links:
                self.linked += len(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections such as <![CDATA[...]]> are markup, whatever they hold."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def unknown_decl(self, data: str) -> None:
        pass


def page_lines(html: str, threshold: int = 80) -> list[tuple[str, int, bool]]:
    """The lines of a page; those of a form that wraps nothing are empty.

    A form wraps what is in it if an article begins there, or if it holds over half of the text
    there is (of the marked article's, where there is one), and as much as the threshold.
    """
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser._end_line()
    inside = any(marked and text for text, _, marked, _ in parser.lines)
    held = [0] * (parser.forms + 1)
    for text, linked, marked, form in parser.lines:
        if marked or not inside:
            held[form] += len(text) - linked
    most = max(threshold, sum(held) // 2 + 1)
    wraps = [not form or form in parser.wrapping or n >= most for form, n in enumerate(held)]
    return [(text, linked, marked) if wraps[form] else ("", 0, marked) for text, linked, marked, form in parser.lines]


def _listed_end(lines: list[tuple[str, int, bool]], weights: list[int], order: list[int], window: int) -> int:
    """How many lines of an article, from one end, come before its first with weight, or before
    the few links, fewer than a window, that stand next to it, such as a linked heading."""
    first = next((at for at, i in enumerate(order) if weights[i]), 0)
    return 0 if sum(bool(lines[i][0]) for i in order[:first]) < window else first


def main_text(html: str | None, window: int = 3, threshold: int = 80) -> str:
    """The article's blocks in page order, joined by one space; empty if there is none.

    Lines that are mostly links weigh nothing. If no window reaches the threshold the
    heaviest one sets it. In a marked article any line that is not mostly links reaches it, and
    what is cut off are a window of links or more at either end.
    """
    lines = page_lines(html or "", threshold)
    inside = any(marked and text for text, _, marked in lines)
    if inside:
        lines = [line for line in lines if line[2]]
    weights = [0 if 2 * linked > len(text) else len(text) for text, linked, _ in lines]
    if inside:
        order = range(len(lines))
        if not any(weights):
            return " ".join(text for text, _, _ in lines if text)
        low = _listed_end(lines, weights, list(order), window)
        high = len(lines) - _listed_end(lines, weights, list(reversed(order)), window)
        return " ".join(text for text, _, _ in lines[low:high] if text)
    sums = [sum(weights[i : i + window]) for i in range(len(lines))]
    most = max(sums, default=0)
    if not most:
        return ""
    reached = [i for i, total in enumerate(sums) if total >= min(threshold, most)]
    surge, dive = reached[0], reached[-1]
    while surge and sums[surge - 1]:
        surge -= 1
    while dive < len(sums) and sums[dive]:
        dive += 1
    weighty = [i for i in range(surge, dive) if weights[i]]
    return " ".join(lines[i][0] for i in range(weighty[0], weighty[-1] + 1) if lines[i][0])


def extract(
    df: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars", window: int = 3, threshold: int = 80
) -> DataFrame:
    """Adds the main text of every page and its length in code points. No shuffle.

    The whole html is read: character references are decoded, white space inside a block
    becomes one space, blocks are joined by one space in page order. A null or empty html,
    or one without an article, gives an empty text. Unclosed and stray tags are borne. Long
    pages are read whole, repeated rows each, an empty table stays empty. Given columns named
    like a result are replaced, others stay.
    """

    def run(pages: pa.Array) -> list[pa.Array]:
        made = [main_text(p, window, threshold) for p in pages.to_pylist()]
        return [pa.array(made, pa.string()), pa.array([len(m) for m in made], pa.int64())]

    return append_columns(df, [html], [(text, T.StringType()), (n_chars, T.LongType())], run)
