"""A linear scanner of HTML: leaf blocks in page order, each with the path of its open elements.

Every character is passed a bounded number of times, whatever is malformed: what a search did not
find is not searched for again, and the stack of open elements has a bounded depth.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

#: Elements whose content is no markup, elements that are not shown, elements within
#: a line, elements without an end tag, elements that a head may hold.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("noscript template svg object select button canvas math audio video".split())
HIDDEN_IN_LINE = frozenset(("svg", "button", "math"))
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("head meta link base script style title noscript template".split())
#: Elements that an opened one ends, and those that may lie between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LOOSE = frozenset(("p", "li", "dt", "dd", "tr", "td", "th", "option"))
#: Elements nested deeper add no path; their text counts all the same.
DEPTH = 256

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile(r"[>\"']")
RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in RAW}
MARKS = re.compile(r"""(?<!\S)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PIECES = re.compile(r"[A-Za-z]+")
SPACES = re.compile(r"\s+")


@dataclass
class Block:
    """A run of text between block-level tags; ``linked`` characters of it are in links."""

    path: tuple[str, ...]
    text: str
    linked: int


@lru_cache(4096)
def marks(name: str, rest: str) -> str:
    """An element's name with the words of its class, id and role."""
    words = [w.lower() for m in MARKS.finditer(rest) for w in PIECES.findall(m[2] or m[3] or m[4] or "")]
    return " ".join([name, *words])


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start and end of the text before, sign, name, attributes) of each tag; sign is '', '/' or '!' for what is no element."""
    size, missing = len(page), set()

    def find(what: str, start: int) -> int:
        k = -1 if what in missing else page.find(what, start)
        if k < 0:
            missing.add(what)
        return k

    def end_of_tag(k: int) -> int:
        while stop := STOP.search(page, k):
            k = stop.end()
            if stop[0] == ">":
                return k - 1
            before = stop.start() - 1
            while page[before].isspace():
                before -= 1
            if page[before] == "=":
                shut = find(stop[0], k)
                after = page[shut + 1 : shut + 2]
                # a quote that is never shut, or only by the next tag's own, is no quote
                if shut >= 0 and (not after or after.isspace() or after in "/>" or ">" not in page[k:shut]):
                    k = shut + 1
        return -1

    begin = at = 0
    while (lt := page.find("<", at)) >= 0:
        if page.startswith("<!--", lt):
            stop = find("-->", lt + 4)
            at = stop + 3 if stop >= 0 else size
        elif page.startswith(("<!", "<?"), lt):
            stop = find(">", lt)
            at = stop + 1 if stop >= 0 else size
        else:
            sign = "/" if page.startswith("/", lt + 1) else ""
            named = NAME.match(page, lt + 1 + len(sign))
            if not named:
                at = lt + 1
                continue
            stop = end_of_tag(named.end())
            if stop < 0:  # the page is cut off within a tag
                yield begin, lt, "!", "", ""
                return
            name = named[0].lower()
            yield begin, lt, sign, name, page[named.end() : stop]
            begin = at = stop + 1
            if not sign and name in RAW:
                shut = None if name in missing else RAW_END[name].search(page, at)
                if shut:
                    begin = at = shut.start()
                else:
                    missing.add(name)
                    if name in ("script", "style"):
                        return
            continue
        yield begin, lt, "!", "", ""
        begin = at
    yield begin, size, "!", "", ""


@dataclass(slots=True)
class Open:
    """An open element; a hidden one holds what was before it, in case that it is never closed."""

    name: str
    path: tuple[str, ...]
    blocks: int = 0
    held: list[str] = field(default_factory=list)
    linked: int = 0


class Reader:
    """Builds the blocks of one page from its tags."""

    def __init__(self):
        self.out: list[Block] = []
        self.stack: list[Open] = []
        self.count: Counter = Counter()
        self.held: list[str] = []
        self.linked = 0
        self.in_head = False

    def block(self, held: list[str], linked: int) -> list[Block]:
        text = SPACES.sub(" ", html.unescape("".join(held))).strip()
        return [Block(self.stack[-1].path if self.stack else (), text, linked)] if text else []

    def close(self) -> None:
        if self.held:
            self.out += self.block(self.held, self.linked)
        self.held, self.linked = [], 0

    def push(self, name: str, path: tuple[str, ...]) -> None:
        hidden = name in HIDDEN
        if len(self.stack) < DEPTH * (1 + hidden):
            self.stack.append(Open(name, path, len(self.out), self.held, self.linked) if hidden else Open(name, path))
            self.count[name] += 1
            if hidden:
                self.held, self.linked = [], 0

    def pop(self, k: int, own: bool = False) -> None:
        """Close the elements from the top down to place ``k``; ``own``: by its own end tag."""
        while len(self.stack) > k:
            hides = self.stack[-1].name in HIDDEN
            if hides and not (own and len(self.stack) == k + 1):
                self.close()  # never closed: what follows it is no part of it
            top = self.stack.pop()
            self.count[top.name] -= 1
            if hides and own and len(self.stack) == k:
                del self.out[top.blocks :]
                self.held, self.linked = [*top.held, " "], top.linked
            elif hides and top.held:
                self.out[top.blocks : top.blocks] = self.block(top.held, top.linked)

    def text(self, piece: str) -> None:
        if self.in_head:
            if not piece.strip():
                return
            self.in_head = False
        self.held.append(piece)
        if self.count["a"]:
            self.linked += len(piece.strip())

    def inline(self, sign: str, name: str, rest: str) -> None:
        if name == "br":
            self.held.append(" ")
        elif not sign:
            if name not in VOID and not rest.endswith("/"):
                self.push(name, self.stack[-1].path if self.stack else ())
        elif self.count[name]:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k].name == name:
                    del self.stack[k]
                    self.count[name] -= 1
                    return
                if self.stack[k].name not in INLINE:
                    return

    def tag(self, sign: str, name: str, rest: str) -> None:
        if name == "head":
            self.close()
            self.in_head = not sign
            return
        if self.in_head and not sign and name not in IN_HEAD:
            self.in_head = False
        if name in INLINE:
            return self.inline(sign, name, rest)
        if name in RAW:  # its content is gone; it breaks no line
            if name not in ("script", "style", "title") and not self.in_head:
                self.held.append(" ")
            return None
        if sign and name in HIDDEN:
            place = next((k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k].name == name), None) if self.count[name] else None
            return None if place is None else self.pop(place, own=True)
        if not sign and name in HIDDEN_IN_LINE:
            return None if rest.endswith("/") else self.push(name, self.stack[-1].path if self.stack else ())
        self.close()
        if name in VOID or self.in_head and name not in HIDDEN:
            return None
        if sign:
            place = next((k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k].name == name), None) if self.count[name] else None
            return None if place is None else self.pop(place)
        ended = ENDS.get(name, ())
        place = None
        for k in range(len(self.stack) - 1, -1, -1):
            above = self.stack[k].name
            if above in ended or above == "p":
                place = k
            elif above not in INLINE and above not in LOOSE:
                break
        if place is not None:
            self.pop(place)
        if not rest.endswith("/") or name not in HIDDEN:
            self.push(name, (*(self.stack[-1].path if self.stack else ()), marks(name, rest)))
        return None


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order; head, scripts, styles, comments and form controls never make one."""
    reader = Reader()
    for a, b, sign, name, rest in tags(page):
        if b > a:
            reader.text(page[a:b])
        if name:
            reader.tag(sign, name, rest)
    reader.pop(0)
    reader.close()
    return reader.out
