"""HTML pages as trees of blocks, for operator 12.

``parse`` reads any string as HTML, as browsers do: comments, scripts, styles and other unseen contents are
left out, end tags that open nothing are ignored, elements that a new one closes are closed.  A tree holds
block elements only; text between two block borders is a leaf: the element itself if it holds nothing else,
or a node of its own (tag ``#text``).  Inline markup is dropped, character references are decoded, white
space becomes one space.  Time is linear in
the length of the page for every well- or ill-formed input of bounded depth.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Names of HTML elements.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary
table tbody td tfoot th thead tr ul""".split())
UNSEEN_TAGS = frozenset("button canvas iframe math noframes noscript object option script select style svg template textarea title".split())
TEXT_ONLY_TAGS = frozenset("script style textarea title".split())
VOID_BLOCKS = frozenset(["hr"])
CONTROL_TAGS = frozenset("button input label select textarea".split())
MEDIA_TAGS = frozenset("audio img picture svg video".split())
#: A start tag closes the nearest open element of the first set, unless one of the second is open above it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
# End of the fixed values.

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """The nodes of a page in document order; node 0 is the root, parents come before their children."""

    tag: list[str] = field(default_factory=lambda: ["#root"])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tokens: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    text: list[str] = field(default_factory=lambda: [""])
    links: list[int] = field(default_factory=lambda: [0])
    controls: list[int] = field(default_factory=lambda: [0])
    media: list[int] = field(default_factory=lambda: [0])

    def add(self, tag: str, parent: int, tokens: tuple[str, ...] = (), text: str = "", links: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tokens.append(tokens)
        self.text.append(text)
        self.links.append(links)
        self.controls.append(0)
        self.media.append(0)
        return len(self.tag) - 1


    def join_only_text(self, node: int) -> None:
        """An element whose only child is a text holds the text itself."""
        if len(self.tag) == node + 2 and self.tag[-1] == "#text":
            self.text[node], self.links[node] = self.text[-1], self.links[-1]
            for column in (self.tag, self.parent, self.depth, self.tokens, self.text, self.links, self.controls, self.media):
                column.pop()


def attribute_tokens(attributes: str) -> tuple[str, ...]:
    """Lower-case words of class, id, role and itemprop."""
    if "=" not in attributes:
        return ()
    values = (m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes))
    return tuple(w.lower() for value in values for w in _TOKEN.findall(value))


class _Builder:
    def __init__(self, source: str):
        self.source, self.lower = source, None
        self.page = Page()
        self.open: list[tuple[str, int]] = []
        self.count: Counter[str] = Counter()
        self.run: list[str] = []
        self.link_chars = 0
        self.link_depth = -1
        self.absent: set[str] = set()

    def node(self) -> int:
        return self.open[-1][1] if self.open else 0

    def say(self, text: str) -> None:
        self.run.append(text)
        if self.link_depth >= 0:
            self.link_chars += len(text.strip())

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self.page.add("#text", self.node(), text=text, links=min(self.link_chars, len(text)))
            self.run, self.link_chars = [], 0

    def close(self) -> None:
        tag, node = self.open.pop()
        self.count[tag] -= 1
        self.page.join_only_text(node)
        if len(self.open) < self.link_depth:
            self.link_depth = -1

    def close_through(self, at: int) -> None:
        self.flush()
        while len(self.open) > at:
            self.close()

    def start(self, tag: str, attributes: str) -> None:
        if tag in CONTROL_TAGS:
            self.page.controls[self.node()] += 1
        if tag in MEDIA_TAGS:
            self.page.media[self.node()] += 1
        if tag == "a":
            self.link_depth = len(self.open)
        elif tag == "br":
            self.run.append(" ")
        elif tag in BLOCK_TAGS or "-" in tag:
            self.flush()
            if self.count["p"]:
                self.close_through(next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == "p"))
            closed, border = CLOSES.get(tag, ((), ()))
            if any(self.count[t] for t in closed):
                for i in range(len(self.open) - 1, -1, -1):
                    if self.open[i][0] in border:
                        break
                    if self.open[i][0] in closed:
                        self.close_through(i)
                        break
            if tag in VOID_BLOCKS:
                return
            self.open.append((tag, self.page.add(tag, self.node(), attribute_tokens(attributes))))
            self.count[tag] += 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link_depth = -1
        elif self.count[tag] and tag not in ("body", "html"):
            at = len(self.open) - 1
            while self.open[at][0] != tag:
                at -= 1
            self.close_through(at)

    def end_of_tag(self, at: int) -> int:
        """Position of the ``>`` of a tag; quotes after an equals sign hide it."""
        source = self.source
        while (m := _STOP.search(source, at)) is not None:
            if m[0] == ">":
                return m.start()
            at = m.end()
            if m[0] not in self.absent and source[max(0, m.start() - 64):m.start()].rstrip().endswith("="):
                close = source.find(m[0], at)
                if close < 0:
                    self.absent.add(m[0])
                else:
                    at = close + 1
        return len(source)

    def after(self, tag: str, at: int) -> int:
        """Where the contents of an unseen element end, or -1."""
        if tag in self.absent:
            return -1
        if self.lower is None:
            self.lower = self.source.lower()
            if len(self.lower) != len(self.source):  # some letters' lower case is longer
                self.lower = self.source.translate(_LOWER)
        close = self.lower.find("</" + tag, at)
        if close < 0:
            self.absent.add(tag)
        return close

    def read(self) -> Page:
        source, at, size = self.source, 0, len(self.source)
        while at < size:
            to = source.find("<", at)
            if to < 0:
                to = size
            if to > at:
                text = source[at:to]
                self.say(html.unescape(text) if "&" in text else text)
            if to == size:
                break
            at = to + 1
            mark = source[at:at + 1]
            if mark == "!" or mark == "?":
                if source.startswith("!--", at):
                    close = source.find("-->", at + 1)
                    at = size if close < 0 else close + 3
                else:
                    close = source.find(">", at)
                    at = size if close < 0 else close + 1
                continue
            ends = mark == "/"
            m = _NAME.match(source, at + ends)
            if m is None:
                if ends:
                    close = source.find(">", at)
                    at = size if close < 0 else close + 1
                else:
                    self.say("<")
                continue
            tag = m[0].lower()
            close = self.end_of_tag(m.end())
            attributes, at = source[m.end():close], close + 1
            if close == size:
                break
            if ends:
                self.end(tag)
                continue
            self.start(tag, attributes)
            if tag in UNSEEN_TAGS and not attributes.endswith("/"):
                close = self.after(tag, at)
                if close >= 0:
                    at = self.end_of_tag(close + 2 + len(tag)) + 1
                elif tag in TEXT_ONLY_TAGS:
                    at = size
        self.close_through(0)
        return self.page


# Only A-Z, so that positions stay the same.
_LOWER = {c: c + 32 for c in range(65, 91)}


def parse(source: str | None) -> Page:
    """The block tree of a page; null is an empty page."""
    return _Builder(source or "").read()
