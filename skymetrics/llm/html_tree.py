"""Element trees of web pages, tolerant of missing end tags.

One pass over the tags with a stack of open elements; what is implied (a ``<p>``
ends at the next block, an ``<li>`` at the next ``<li>``) follows the HTML rules as
far as they decide which text stands in which block.  Time is linear in the
page's length, however deep it nests.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict

# Fixed values of HTML: which elements are empty, hold raw text, or make blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form head header"
    " hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
CLOSE_P = BLOCKS - frozenset("body caption head html legend option optgroup select tbody td tfoot th thead title tr".split())
SCOPE = frozenset("html table td th caption button object template".split())
IN_HEAD = frozenset("base head html link meta noscript script style template title".split())
#: a start tag ends the nearest open element of these, if no element of the second kind stands between
ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select datalist"),
    "optgroup": ("option optgroup", "select"), "td": ("td th", "table"), "th": ("td th", "table"), "tr": ("td th tr caption", "table"),
    "tbody": ("td th tr caption thead tbody tfoot", "table"), "thead": ("td th tr caption thead tbody tfoot", "table"),
    "tfoot": ("td th tr caption thead tbody tfoot", "table"),
}
ENDS = {tag: (a.split(), b.split()) for tag, (a, b) in ENDS.items()}

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])|\Z", re.I) for tag in RAW}


class Tree:
    """Elements in page order, and what happens in the page: starts, ends and texts.

    ``events`` holds a text, the number of an element that starts, or ``~number``
    of one that ends.  ``digests`` names the tags and texts of an element's subtree (None without text).
    """

    def __init__(self, page: str):
        self.tags: list[str] = []
        self.attributes: list[str] = []
        self.parents: list[int] = []
        self.digests: list[bytes | None] = []
        self.events: list[int | str] = []
        self._stack: list[int] = []
        self._open: dict[str, list[int]] = defaultdict(list)  # stack places of each tag
        self._scope: list[int] = []
        self._blocks: list[int] = []
        self._inside: list[list[bytes]] = [[]]
        self._parse(page)

    def _last(self, tags: list[str]) -> int:
        return max((self._open[t][-1] for t in tags if self._open[t]), default=-1)

    def _push(self, tag: str, attributes: str) -> None:
        n = len(self.tags)
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.parents.append(self._stack[-1] if self._stack else -1)
        self.digests.append(None)
        self.events.append(n)
        place = len(self._stack)
        self._stack.append(n)
        self._open[tag].append(place)
        if tag in SCOPE:
            self._scope.append(place)
        if tag in BLOCKS:
            self._blocks.append(place)
        self._inside.append([])

    def _pop_to(self, place: int) -> None:
        """End every open element from the stack's end down to ``place``."""
        while len(self._stack) > place:
            n = self._stack.pop()
            tag = self.tags[n]
            self._open[tag].pop()
            if tag in SCOPE:
                self._scope.pop()
            if tag in BLOCKS:
                self._blocks.pop()
            parts = self._inside.pop()
            name = b"<" + tag.encode("utf-8", "surrogatepass") + b">"
            if parts:
                self.digests[n] = hashlib.blake2b(name + b"".join(parts), digest_size=16).digest()
                self._inside[-1].append(b"<" + self.digests[n])
            self.events.append(~n)

    def _text(self, text: str, raw: bool = False) -> None:
        if not text:
            return
        if not raw and "&" in text:
            text = html.unescape(text)
        self.events.append(text)
        words = " ".join(text.split())
        if words:
            self._inside[-1].append(b">" + words.encode("utf-8", "surrogatepass"))

    def _start(self, tag: str, attributes: str) -> None:
        if self._open["head"] and tag not in IN_HEAD:
            self._pop_to(self._open["head"][-1])
        if tag in ("html", "head", "body") and self._open[tag]:
            return
        if tag in CLOSE_P and self._open["p"] and self._open["p"][-1] > (self._scope[-1] if self._scope else -1):
            self._pop_to(self._open["p"][-1])
        if tag in HEADINGS and self._stack and self.tags[self._stack[-1]] in HEADINGS:
            self._pop_to(len(self._stack) - 1)
        if tag in ENDS:
            ended, limits = ENDS[tag]
            limit = self._last(limits)
            first = min((self._open[t][-1] for t in ended if self._open[t] and self._open[t][-1] > limit), default=-1)
            if first >= 0:
                self._pop_to(first)
        self._push(tag, attributes)
        if tag in VOID or (attributes.endswith("/") and tag not in BLOCKS and tag not in RAW):
            self._pop_to(len(self._stack) - 1)

    def _end(self, tag: str) -> None:
        if not self._open[tag]:
            if tag == "p" or tag == "br":  # as an empty one
                self._start(tag, "")
                if self._open[tag]:
                    self._pop_to(self._open[tag][-1])
            return
        place = self._open[tag][-1]
        limits = self._scope if tag in BLOCKS or tag in SCOPE else self._blocks
        while limits and limits[-1] > place:
            if tag in ("body", "html", "table", "template") or tag in SCOPE:
                break
            return
        self._pop_to(place)

    def _parse(self, page: str) -> None:
        at = 0
        while True:
            found = _TOKEN.search(page, at)
            if not found:
                break
            self._text(page[at:found.start()])
            at = found.end()
            tag = found["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if found["end"]:
                self._end(tag)
                continue
            self._start(tag, found["attributes"])
            if tag in RAW:
                end = _RAW_END[tag].search(page, at)
                self._text(page[at:end.start()], raw=tag not in ("textarea", "title"))
                at = end.start()
        self._text(page[at:])
        self._pop_to(0)
