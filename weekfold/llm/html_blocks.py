"""Leaf blocks of an HTML page: stretches of text between block-level tags, with their tag paths."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements by their role in the HTML standard.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template iframe object svg math canvas audio video select textarea".split())
#: Those of them that reach to the end of the page if nothing ends them.
TO_THE_END = frozenset("script style noscript template iframe textarea".split())
HEAD_ONLY = frozenset(["head", "title"])
#: Any other tag, or text, ends an open head.
IN_HEAD = frozenset("html head title base link meta script style noscript template".split())
#: An opening tag of the first kind ends an open element of the second within the same parent.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"}, "body": {"head", "title"},
}
#: Such a tag ends an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol pre section table ul".split()
)
#: Implied ends don't reach beyond these.
WALLS = frozenset("ul ol dl table tbody thead tfoot article section div main aside nav body html form".split())

#: Elements deeper than this stand side by side, as in browsers.
DEEPEST = 512

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)"
    # quoted values may hold a "<" or ">"; a tag with an open quote, or one that another tag interrupts, ends at the next ">"
    r"((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*+)>", re.DOTALL
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Path:
    """An element with its tag and the words of its class, id and role, and what it is in."""

    __slots__ = ("tag", "names", "parent", "depth")

    def __init__(self, tag: str, names: tuple[str, ...] = (), parent: Path | None = None):
        self.tag, self.names, self.parent = tag, names, parent
        self.depth = parent.depth + 1 if parent else 1

    @classmethod
    def of(cls, elements) -> Path | None:
        """From (tag, names) pairs, outermost first."""
        path = None
        for tag, names in elements:
            path = cls(tag, names, path)
        return path


@dataclass
class Block:
    path: Path | None  # innermost element
    text: str
    links: int = 0  # characters inside links
    tags: int = 0  # inline tags inside


@dataclass
class _Open:
    text: list[str] = field(default_factory=list)
    links: int = 0
    tags: int = 0


class _Elements:
    """The open block-level elements; what an end or an implied end looks for is found without a walk.

    Elements between two walls form a region, which knows where its tags are
    open; each element counts the inline elements that are open in it.
    """

    def __init__(self):
        self.open: list[Path] = []
        self.inline: list[dict[str, int]] = [{}]
        self.count: dict[str, int] = {}
        self.regions: list[dict[str, list[int]]] = [{}]
        self.links = self.hidden = 0

    @property
    def path(self) -> Path | None:
        return self.open[-1] if self.open else None

    def top(self, tag: str) -> bool:
        return bool(self.open) and self.open[-1].tag == tag

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        parent = self.path
        if parent is not None and parent.depth >= DEEPEST:
            parent = parent.parent
        self.regions[-1].setdefault(tag, []).append(len(self.open))
        if tag in WALLS:
            self.regions.append({})
        self.open.append(Path(tag, names, parent))
        self.inline.append({})
        self.count[tag] = self.count.get(tag, 0) + 1
        self.hidden += tag in HEAD_ONLY

    def pop(self) -> None:
        tag = self.open.pop().tag
        self.links -= self.inline.pop().get("a", 0)
        self.count[tag] -= 1
        self.hidden -= tag in HEAD_ONLY
        if tag in WALLS:
            self.regions.pop()
        self.regions[-1][tag].pop()

    def end(self, tag: str) -> None:
        """Close the innermost element of this name and all in it; a stray end is ignored."""
        if self.count.get(tag):
            while self.open[-1].tag != tag:
                self.pop()
            self.pop()

    def imply(self, tag: str) -> None:
        """Close what an opening ``tag`` closes, up to the last wall."""
        closed = CLOSES.get(tag, frozenset(["p"]) if tag in ENDS_PARAGRAPH else frozenset())
        region = self.regions[-1]
        outermost = min((region[t][0] for t in closed if region.get(t)), default=None)
        while outermost is not None and len(self.open) > outermost:
            self.pop()

    def start_inline(self, tag: str) -> None:
        own = self.inline[-1]
        own[tag] = own.get(tag, 0) + 1
        self.links += tag == "a"

    def end_inline(self, tag: str) -> None:
        """The innermost one of this name, if no block has begun since."""
        own = self.inline[-1]
        if own.get(tag):
            own[tag] -= 1
            self.links -= tag == "a"


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = " ".join(next(filter(None, m), "") for m in _NAMES.findall(attributes))
    return tuple(_PARTS.findall(_CAMEL.sub(r"\1 \2", found).lower()))


def blocks(page: str) -> list[Block]:
    """The blocks of a page in their order; comments, scripts, styles and the head have none.

    Unclosed and misnested tags are closed as browsers would close them; a
    stray end tag is ignored; text without any tags is one block. The time grows
    with the length of the page, whatever it holds.
    """
    elements = _Elements()
    out: list[Block] = []
    now = _Open()
    endless: set[str] = set()  # unseen elements that nothing ends from here on

    def flush() -> None:
        nonlocal now
        text = " ".join(html.unescape("".join(now.text)).split())
        if text:
            out.append(Block(elements.path, text, min(now.links, len(text)), now.tags))
        now = _Open()

    def add(text: str) -> None:
        if elements.top("head") and text.strip():
            elements.pop()
        if text and not elements.hidden:
            now.text.append(text)
            if elements.links:
                now.links += len(text.strip())

    at, limit = 0, page.rfind(">") + 1  # no tag ends behind it
    whole = True
    while m := _TOKEN.search(page, at, limit):
        add(page[at:m.start()])
        at = m.end()
        end, tag, attributes = m.group(1), m.group(2), m.group(3)
        if tag is None:
            if m.group().startswith("<!--") and not m.group().endswith("-->"):
                whole = False  # a comment that nothing ends
                break
            continue
        tag = tag.lower()
        if elements.top("head") and not end and tag not in IN_HEAD:
            elements.pop()
        if tag in UNSEEN:
            if not end and not attributes.endswith("/"):
                stop = None
                if tag not in endless:
                    stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
                if stop is None:
                    endless.add(tag)
                    if tag in TO_THE_END:
                        whole = False
                        break
                    continue
                at = page.find(">", stop.start()) + 1 or len(page)
            continue
        if tag in INLINE:
            now.tags += 1
            (elements.end_inline if end else elements.start_inline)(tag)
            continue
        if tag in ("br", "wbr") or tag in VOID and tag != "hr":
            if tag == "br":
                now.text.append("\n")
            continue
        flush()
        if end:
            elements.end(tag)
            continue
        elements.imply(tag)
        if tag not in VOID:
            elements.push(tag, _names(attributes))
    if whole:
        add(page[at:].split("<!--", 1)[0])
    flush()
    return out
