"""One forward scan of a page's markup into text blocks and the containers that hold them.

The scan moves ahead with every step (comments, raw elements and quoted values that never
close end the page), and the open elements are counted per name, so that an end tag without
its start costs nothing: time is linear in the page whatever the markup.
"""
from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

from .common import unescape

#: Fixed names.  Elements whose content is never text, and those read up to their own end tag.
RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Menus, headers, footers, sidebars, forms and controls.
OUTSIDE = frozenset("nav header footer aside form button select option datalist object svg math canvas "
                    "audio video menu dialog label fieldset applet".split())
CONTAINERS = frozenset("body div article main section td th center".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr caption blockquote pre address figure "
    "figcaption details summary hgroup hr legend nav header footer aside form fieldset menu dialog".split())
#: Their start ends a neighbour of the same name that was left open.
REPEATED = frozenset("li dt dd tr td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never taken for clutter because of a class of theirs.
TRUSTED = frozenset("body main article".split())
#: Words in class, id and role that mark clutter: menus, adverts, notices, comments, forms, sharing.
CLUTTER = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot banner promo promotion sponsor "
    "sponsored sponsors nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar header masthead "
    "topbar footer copyright colophon sidebar aside widget widgets complementary related recommended recommendations "
    "trending comment comments disqus respond reply replies cookie cookies consent gdpr notice notices alert popup "
    "modal overlay dialog newsletter subscribe subscription signup login share sharing social form search skip "
    "contentinfo".split())
#: Beside one of these a word only says what else is on the page ("has-sidebar").
ABOUT = frozenset("has with without no".split())

_OPEN = re.compile(r"[a-zA-Z][^\s/>]*")
_NEXT = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PARTS = re.compile(r"[A-Za-z][a-z]*|[0-9]+")
_SHUT = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Page:
    """``parent`` and ``label`` of every container (a root comes first) and the blocks: the text,
    its container and how many of its characters are link text."""
    parent: list[int] = field(default_factory=lambda: [-1])
    label: list[str] = field(default_factory=lambda: [""])
    texts: list[str] = field(default_factory=list)
    owner: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    title: str = ""


def attributes(markup: str) -> dict[str, str]:
    """Attributes of a tag's inside; of repeated ones the first."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(markup):
        out.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return out


def generalised(tag: str, found: dict[str, str]) -> str:
    """The tag with its classes in order; numbers in them are one sign, so numbered classes agree."""
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in found.get("class", "").split()})
    return ".".join([tag, *classes])


def is_clutter(tag: str, found: dict[str, str]) -> bool:
    if tag in OUTSIDE:
        return True
    if "hidden" in found or _HIDDEN.search(found.get("style", "")):
        return tag != "body"
    if tag in TRUSTED:
        return False
    for name in f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".split():
        words = [w.lower() for w in _PARTS.findall(name)]
        if not CLUTTER.isdisjoint(words) and ABOUT.isdisjoint(words):
            return True
    return False


def quoted(markup: str, at: int, least: int) -> bool:
    """Whether the quote at ``at`` opens a value: the last sign before it, blanks aside, is "="."""
    at -= 1
    while at > least and markup[at] in " \t\n\r\f":
        at -= 1
    return at >= least and markup[at] == "="


def tag_end(markup: str, at: int) -> int:
    """Place of the ">" that ends the tag whose name ends at ``at``; -1 if it never ends."""
    look = at
    while True:
        mark = _NEXT.search(markup, look)
        if not mark:
            return -1
        if mark[0] == ">":
            return mark.start()
        look = mark.end()
        if quoted(markup, mark.start(), at):
            look = markup.find(mark[0], look) + 1
            if not look:
                return -1


def parse(markup: str) -> Page:
    """Blocks and containers of a page."""
    page = Page()
    # open elements: (tag, container around it, counts as clutter, is a link)
    stack: list[tuple[str, int, bool, bool]] = []
    opened: Counter[str] = Counter()
    inline: list[Counter[str]] = [Counter()]  # inline elements open inside each open block
    node = clutter = links = link_chars = heading = 0
    buffer: list[str] = []
    at, end = 0, len(markup)

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                page.texts.append(text)
                page.owner.append(node)
                page.linked.append(min(link_chars, len(text)))
        link_chars = 0

    def text(part: str) -> None:
        nonlocal link_chars
        # a heading in the header of an article is the article's own
        if part and (not clutter or (heading and opened["header"] == clutter and (opened["article"] or opened["main"]))):
            part = unescape(part) if "&" in part else part
            buffer.append(part)
            if links:
                link_chars += len(part.strip())

    def close(tag: str) -> None:
        """End the open elements up to and with the innermost ``tag``."""
        nonlocal node, clutter, links, heading
        while True:
            name, around, was_clutter, was_link = stack.pop()
            opened[name] -= 1
            if name in BLOCKS:
                flush()
                inline.pop()
            else:
                inline[-1][name] -= 1
            heading -= name in HEADINGS
            node, clutter, links = around, clutter - was_clutter, links - was_link
            if name == tag:
                return

    while at < end:
        lt = markup.find("<", at)
        if lt < 0:
            text(markup[at:])
            break
        text(markup[at:lt])
        if markup.startswith(("<!", "<?"), lt):
            shut = "-->" if markup.startswith("<!--", lt) else ">"
            stop = markup.find(shut, lt + 2)
            at = end if stop < 0 else stop + len(shut)
            continue
        closing = markup.startswith("</", lt)
        name = _OPEN.match(markup, lt + 1 + closing)
        if not name:
            # a bare "<" is text; "</" without a name runs to the next ">"
            text("" if closing else "<")
            stop = markup.find(">", lt) if closing else lt
            at = end if stop < 0 else stop + 1
            continue
        tag, stop = name[0].lower(), tag_end(markup, name.end())
        if stop < 0:
            break  # the tag never ends, so neither does the page
        inside, at = markup[name.end():stop], stop + 1
        if closing:
            if tag in BLOCKS:
                flush()
                if opened[tag] > 0:
                    close(tag)
            elif inline[-1][tag] > 0:
                close(tag)
        elif tag in RAW:
            shut = _SHUT[tag].search(markup, at)
            if tag == "title" and not page.title:
                page.title = " ".join(unescape(markup[at:shut.start() if shut else end]).split())
            stop = markup.find(">", shut.end()) if shut else -1
            at = end if stop < 0 else stop + 1
        elif tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text(" ")
        elif tag not in ("html", "head", "body") or (tag == "body" and not opened["body"]):
            if tag in BLOCKS:
                if opened["p"] > 0:
                    close("p")
                flush()
                if tag in REPEATED and stack and stack[-1][0] == tag:
                    close(tag)
            found = attributes(inside) if inside else {}
            around = node
            if tag in CONTAINERS:
                page.parent.append(node)
                page.label.append(generalised(tag, found))
                node = len(page.parent) - 1
            made, link = is_clutter(tag, found), tag == "a"
            stack.append((tag, around, made, link))
            opened[tag] += 1
            if tag in BLOCKS:
                inline.append(Counter())
            else:
                inline[-1][tag] += 1
            clutter, links, heading = clutter + made, links + link, heading + (tag in HEADINGS)
    flush()
    return page
