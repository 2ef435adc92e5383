"""HTML to leaf blocks: runs of text between block-level tags, each with the path of its open elements."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Elements of HTML that start a new block, have no content, are never shown, or end implicitly.
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = set("script style template iframe svg canvas audio video textarea".split())
# Elements that a slash in their start tag closes.
FOREIGN_TAGS = {"svg", "math"}
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "body": {"head"},
}
# An implied end does not reach beyond these.
SCOPES = set("table ul ol dl div section article main aside nav header footer form blockquote body html".split())

_NAME = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    path: tuple[str, ...]
    leaf: str
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def element_names(tag: str, attributes: list[tuple[str, str | None]]) -> tuple[str, ...]:
    """The tag and the words of class, id and role, marked by a dot."""
    names = [tag]
    for key, value in attributes:
        if key in ("class", "id", "role") and value:
            names.extend("." + n for n in _NAME.findall(value.lower()))
    return tuple(names)


class BlockParser(HTMLParser):
    """Collects blocks; hidden elements, comments and declarations leave nothing."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[Block] = []
        self.current: Block | None = None
        self.hidden = self.links = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _close(self, count: int) -> None:
        for tag, _ in self.open[len(self.open) - count:]:
            self.hidden -= tag in HIDDEN_TAGS
            self.links -= tag == "a"
            if tag in BLOCK_TAGS:
                self.current = None
        del self.open[len(self.open) - count:]

    def _end_implied(self, tag: str) -> None:
        ends = CLOSES.get(tag) or ({"p"} if tag in BLOCK_TAGS else set())
        for back, (name, _) in enumerate(reversed(self.open), 1):
            if name in ends:
                self._close(back)
                if name not in ("td", "th"):
                    return
                return self._end_implied(tag)
            if name in SCOPES:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_implied(tag)
        if tag in BLOCK_TAGS:
            self.current = None
        if tag in VOID_TAGS:
            if tag == "br" and self.current is not None and not self.hidden:
                self.current.pieces.append(" ")
            return
        self.open.append((tag, element_names(tag, attrs)))
        self.hidden += tag in HIDDEN_TAGS
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # a slash ends nothing but void and foreign elements
        if tag not in FOREIGN_TAGS:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for back, (name, _) in enumerate(reversed(self.open), 1):
            if name == tag:
                return self._close(back)

    def handle_data(self, data: str) -> None:
        if self.hidden or not data:
            return
        if self.current is None:
            if data.isspace():
                return
            path = tuple(n for _, names in self.open for n in names)
            leaf = next((t for t, _ in reversed(self.open) if t in BLOCK_TAGS), "")
            self.current = Block(path, leaf)
            self.blocks.append(self.current)
        self.current.pieces.append(data)
        self.current.linked += len(data) if self.links else 0


def leaf_blocks(html: str | None) -> list[Block]:
    """Blocks of the whole page in page order; a null or empty page has none."""
    parser = BlockParser()
    parser.feed(html or "")
    parser.close()
    return parser.blocks
