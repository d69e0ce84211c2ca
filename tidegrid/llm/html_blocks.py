"""Leaf blocks of an HTML page: texts between block-level tags, with features of their ancestors.

A page is read once, front to back, with a stack of its open block-level elements. Sloppy
markup is taken as browsers take it: paragraphs, list items and cells end where the next one
begins, an end tag closes whatever is open inside its element, one without a start is skipped,
and a page may stop anywhere. Features are bits of one integer per element, its ancestors'
bits included, so nesting of any depth costs nothing per block.
"""

from __future__ import annotations

import html
import re

#: Elements that begin and end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())

#: Elements whose content is no text of the page.
SKIPPED_TAGS = frozenset("canvas iframe math noembed noframes noscript object script select style svg template textarea title xmp".split())

#: Elements that have no content, and what an open element is closed by.
VOID_TAGS = frozenset(["hr"])
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
             "th": {"td", "th", "tr", "tbody", "tfoot"}, "tr": {"tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"},
             "tbody": {"tbody", "tfoot"}}

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S)
_MARKS = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SENTENCE = (".", "!", "?", "…", "。", ":", ";", "”", "\"")
_LONGEST = [(1, "1"), (3, "3"), (7, "7"), (15, "15"), (31, "31"), (63, "63")]


class Features:
    """Names of features and their bits; new names get one only while ``open_`` is set."""

    def __init__(self, names: list[str] | None = None):
        self.bits = {name: k for k, name in enumerate(names or [])}
        self.open_ = names is None
        self._elements: dict[tuple[str, str], int] = {}

    def bit(self, name: str) -> int:
        k = self.bits.setdefault(name, len(self.bits)) if self.open_ else self.bits.get(name)
        return 0 if k is None else 1 << k

    def element(self, tag: str, attributes: str) -> int:
        """Bits of an element: its tag and the words of its class, id and role."""
        found = self._elements.get((tag, attributes))
        if found is None:
            found = self.bit(f"in {tag}")
            for value in _MARKS.findall(attributes):
                for word in _WORD.findall(_CAMEL.sub(" ", value).lower()):
                    found |= self.bit(f"word {word}")
            if len(self._elements) > 10_000:
                self._elements.clear()
            self._elements[tag, attributes] = found
        return found

    def text(self, text: str, linked: int, tag: str) -> int:
        """Bits of a block by its own tag and its text, ``linked`` characters of which are links."""
        words = text.count(" ") + 1
        size = next((name for most, name in _LONGEST if words <= most), "more")
        share = 3 * linked // max(len(text), 1)
        found = self.bit(f"of {tag}") | self.bit(f"words {size}") | self.bit(f"links {share}")
        if text.endswith(_SENTENCE):
            found |= self.bit("sentence")
        if "," in text:
            found |= self.bit("comma")
        if "©" in text:
            found |= self.bit("copyright")
        if "|" in text or "·" in text or "»" in text or "›" in text:
            found |= self.bit("separators")
        return found


def leaf_blocks(page: str, features: Features) -> list[tuple[str, int]]:
    """``(text, bits)`` of every block with text, in page order.

    Character references are decoded, runs of white space become one space, ends are trimmed.
    """
    blocks: list[tuple[str, int, str]] = []
    tags, masks, open_tags = ["body"], [0], {"body": 1}
    parts: list[str] = []
    linked = at = 0
    in_link = False

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((text, masks[-1] | features.text(text, min(linked, len(text)), tags[-1])))
            parts.clear()
        linked = 0

    def close() -> None:
        open_tags[tags.pop()] -= 1
        masks.pop()

    while at < len(page):
        mark = _MARKUP.search(page, at)
        stop = mark.start() if mark else len(page)
        if stop > at:
            text = page[at:stop]
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if in_link:
                linked += len(text)
        if mark is None:
            break
        at = mark.end()
        if mark[2] is None:
            continue
        tag, ends = mark[2].lower(), bool(mark[1])
        if tag in SKIPPED_TAGS:
            if not ends and not mark[3].endswith("/"):
                close_at = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = close_at.end() if close_at else len(page)
        elif tag == "a":
            in_link = not ends
        elif tag == "br":
            parts.append("\n")
        elif tag in BLOCK_TAGS:
            end_block()
            if ends:
                in_link = False
                if tag not in ("body", "html") and open_tags.get(tag):
                    while tags[-1] != tag:
                        close()
                    close()
                continue
            if tags[-1] == "p":
                close()
            while tag in CLOSED_BY.get(tags[-1], ()):
                close()
            if tag not in VOID_TAGS and tag not in ("body", "html"):
                tags.append(tag)
                masks.append(masks[-1] | features.element(tag, mark[3]))
                open_tags[tag] = open_tags.get(tag, 0) + 1
    end_block()
    # Blocks outside the main part, where a page says which one that is.
    inside = features.bit("in article") | features.bit("in main")
    outside = features.bit("outside main")
    if outside and any(bits & inside for _, bits in blocks):
        return [(text, bits if bits & inside else bits | outside) for text, bits in blocks]
    return blocks
