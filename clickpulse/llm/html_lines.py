"""Lines of text of a web page, with the part of the page that each stands in."""

from __future__ import annotations

from html.parser import HTMLParser

# Elements by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body button canvas caption center col colgroup dd "
    "details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup "
    "option p pre search section select summary table tbody td textarea tfoot th thead "
    "title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
FRAME = frozenset(
    "aside button datalist dialog footer form head header iframe menu nav noscript object "
    "script search select style svg template textarea title".split()
)
#: Parts of a class, id or role that mark an element as no part of the article.
MARKS = frozenset(
    "ad ads advert advertisement advertisements advertising adverts alert aside banner "
    "breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies copyright dialog disclaimer discussion disqus footer form gdpr header "
    "hidden legal login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination popup promo promoted promotion recommended "
    "related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription tags toolbar tooltip tracking widget widgets".split()
)

ARTICLE, OPEN, MARKED = 0, 1, 2


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    values = {name: value or "" for name, value in attrs}
    if "hidden" in values or values.get("aria-hidden") == "true":
        return True
    style = values.get("style", "").replace(" ", "").lower()
    return "display:none" in style or "visibility:hidden" in style


def _named(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether class, id or role say that an element is no part of the article."""
    values = {name: value or "" for name, value in attrs}
    names = " ".join(values.get(n, "") for n in ("class", "id", "role")).lower()
    return not MARKS.isdisjoint("".join(c if c.isalnum() else " " for c in names).split())


class _Reader(HTMLParser):
    """Collects lines; names of elements count for article and main, and at all, if asked to."""

    def __init__(self, articles_by_name: bool = True, by_name: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.articles_by_name, self.by_name = articles_by_name, by_name
        #: Whether an article or main element was left out for its name.
        self.left_out = False
        self.lines: list[tuple[str, int]] = []
        self.held: list[str] = []
        self.held_part = OPEN
        #: Open elements as (tag, part before it).
        self.stack: list[tuple[str, int]] = []
        self.part = OPEN

    def flush(self) -> None:
        """End a block. Its part is that of its text: parts other than MARKED change at blocks."""
        line = " ".join("".join(self.held).split())
        self.held.clear()
        if line:
            self.lines.append((line, self.held_part))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.held.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
        if tag in VOID:
            return
        part = self.part
        if tag in ("article", "main"):
            inside = any(t == "article" for t, _ in self.stack)
            named = _named(attrs)
            if tag == "article" and inside or _hidden(attrs):
                part = MARKED  # an article within an article is a comment
            elif named and self.articles_by_name:
                part, self.left_out = MARKED, True
            elif not inside:
                part = ARTICLE  # whatever was left open before it
        elif tag == "header" and part == ARTICLE and not self._marked(attrs):
            pass  # the heading of the article
        elif part != MARKED and tag not in ("html", "body"):
            if tag in FRAME or self._marked(attrs):
                part = MARKED
        self.stack.append((tag, self.part))
        self.part = part

    def _marked(self, attrs: list[tuple[str, str | None]]) -> bool:
        return _hidden(attrs) or self.by_name and _named(attrs)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash closes nothing but void elements.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        for n in range(len(self.stack) - 1, -1, -1):
            if self.stack[n][0] == tag:
                self.part = self.stack[n][1]
                del self.stack[n:]
                return
            # Inline elements left open end with their block, never the other way round.
            if tag not in BLOCKS and self.stack[n][0] in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if self.part != MARKED:
            self.held.append(data)
            self.held_part = self.part


def page_lines(html: str) -> list[tuple[str, int]]:
    """The blocks of text in page order, each with ARTICLE or OPEN.

    ARTICLE stands in the article or main element, OPEN anywhere else; text in elements that
    frame a page is left out. Character references are decoded, white space is one space.
    Class words only choose between parts of a page: if they leave out its only article
    element, or all of its text, the page is read without looking at them there.
    """
    reader = _read(html)
    if reader.left_out and all(part != ARTICLE for _, part in reader.lines):
        reader = _read(html, articles_by_name=False)
    if not reader.lines:
        reader = _read(html, articles_by_name=False, by_name=False)
    return reader.lines


def _read(html: str, **names: bool) -> _Reader:
    reader = _Reader(**names)
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader
