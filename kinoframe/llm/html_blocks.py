"""A web page as a tree of block elements, lenient about what authors leave out.

Elements that start a block make nodes; markup inside a line does not, it is text. A node's
signature is its name, the words of its class, id and role, and what kinds of children it
holds, so that siblings with the same work have the same signature. Character references are
decoded and white space is one space. Closing tags that are missing are taken from the
element that follows, closing tags without an opening one are passed over, and elements
nested more than ``DEPTH`` deep belong to the node at that depth.
"""

from __future__ import annotations

import re
from html import unescape

# Names of HTML elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "html head body main article section nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr blockquote pre "
    "figure figcaption address form fieldset legend button select option optgroup datalist label output dialog menu details summary center noscript template svg math canvas object "
    "audio video search hgroup script style textarea title iframe noembed noframes xmp td th".split()
)
#: Elements that a following one of the second set ends, if no element of the third set lies between.
ENDS = (
    (frozenset({"p"}), BLOCK - {"button", "label", "output", "script", "style", "template", "select", "option", "noscript", "svg", "math"}, frozenset({"button", "td", "th", "caption", "object", "li", "dd", "dt", "div", "section", "article"})),
    (frozenset({"li"}), frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    (frozenset({"dt", "dd"}), frozenset({"dt", "dd"}), frozenset({"dl"})),
    (frozenset({"option"}), frozenset({"option", "optgroup"}), frozenset({"select", "datalist"})),
    (frozenset({"td", "th"}), frozenset({"td", "th", "tr", "tbody", "thead", "tfoot"}), frozenset({"table"})),
    (frozenset({"tr"}), frozenset({"tr", "tbody", "thead", "tfoot"}), frozenset({"table"})),
    (frozenset({"thead", "tbody", "tfoot"}), frozenset({"tbody", "thead", "tfoot"}), frozenset({"table"})),
    (frozenset({"head"}), frozenset({"body", "main", "article", "section", "nav", "header", "footer", "aside", "div", "p", "h1", "ul", "table"}), frozenset({"body"})),
)
#: Parts of a table or list of choices that go on in the line of what holds them.
LINE = frozenset({"td", "th", "tbody", "thead", "tfoot", "template", "option", "optgroup"})
CONTAINERS = frozenset("div section td th li center blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")
DEPTH = 40


class Node:
    """A block element: its name, its words, and children, nodes or (text, characters of it in links)."""

    __slots__ = ("children", "hidden", "name", "role", "signature", "words")

    def __init__(self, name: str, words: tuple = (), role: str = "", hidden: bool = False):
        self.name, self.words, self.role, self.hidden = name, words, role, hidden
        self.children: list = []
        self.signature = ""

    def sign(self) -> None:
        """Signatures of the whole tree, from the leaves up."""
        for child in self.children:
            if type(child) is Node:
                child.sign()
        shape = ""
        if self.name in CONTAINERS and not self.words:
            kinds = {"#" if type(c) is tuple else "p" if c.name in HEADINGS or c.name == "p" else "l" if c.name in ("ul", "ol", "dl", "menu") else "+" for c in self.children}
            shape = "/" + "".join(sorted(kinds))
        self.signature = self.name + "".join(f".{w}" for w in self.words) + shape


def _described(rest: str) -> tuple[tuple, str, bool]:
    """Words of class and id, the role, and whether the element is hidden."""
    words, role, hidden = set(), "", False
    for name, *values in ATTRIBUTE.findall(rest):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id"):
            for token in value.split():
                parts = [w.lower() for w in HUMP.split(token) if w]
                # has-sidebar and the like say what lies elsewhere.
                if parts and parts[0] not in ("has", "with", "no", "is", "js"):
                    words.update(parts)
        elif name in ("role", "itemprop"):
            role = value.lower()
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower())):
            hidden = True
    return tuple(sorted(words)), role, hidden


def page_tree(html: str) -> Node:
    """The tree of a page; its root is a node without name."""
    root = Node("")
    #: Open elements: (name, node or None for inline ones, whether the text in them is passed over).
    stack: list[tuple] = [("", root, False)]
    parts: list[str] = []
    linked, links = 0, 0

    def node() -> Node:
        return next(entry[1] for entry in reversed(stack) if entry[1] is not None)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            node().children.append((text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not any(entry[2] for entry in stack):
            text = unescape(text)
            parts.append(text)
            linked += len(text) if links else 0

    at, n = 0, len(html)
    while at < n:
        tag = TAG.search(html, at) if html.find("<", at) >= 0 else None
        if tag is None:
            say(html[at:])
            break
        say(html[at : tag.start()])
        at = tag.end()
        closes, name, rest = tag.groups()
        if not name:
            continue
        name = name.lower()
        if closes:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name), 0)
            if name in ("td", "th"):
                parts.append(" ")
            if not k:
                continue
            if name == "a":
                links = 0
            if name in BLOCK and (stack[k][1] is not None or name not in LINE or any(entry[1] is not None for entry in stack[k + 1 :])):
                flush()
                del stack[k:]
                links = sum(entry[0] == "a" for entry in stack)
            elif not any(entry[1] is not None for entry in stack[k + 1 :]):
                del stack[k:]
            else:  # the line's markup ends, the blocks opened in it go on
                del stack[k]
            continue
        if name in VOID:
            parts.append("" if name in ("wbr", "img", "input") else " ")
            if name == "hr":
                flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
            continue
        block = name in BLOCK
        if block:
            for ended, by, between in ENDS:
                if name in by:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in ended:
                            if stack[k][0] not in LINE or any(entry[1] is not None for entry in stack[k:]):
                                flush()
                            del stack[k:]
                            links = sum(entry[0] == "a" for entry in stack)
                            break
                        if stack[k][0] in between:
                            break
        words, role, hidden = _described(rest) if "=" in rest or "hidden" in rest else ((), "", False)
        if name in ("td", "th"):
            parts.append(" ")
        if block and (name not in LINE or name in ("td", "th") and words):
            flush()
            made = Node(name, words, role, hidden) if len(stack) <= DEPTH else None
            if made is not None:
                node().children.append(made)
            stack.append((name, made, hidden and made is None))
        elif rest.rstrip(">").endswith("/") and name not in BLOCK:
            continue
        else:
            silent = hidden or name in ("template", "option", "optgroup") or bool(AWAY.intersection(words))
            stack.append((name, None, silent))
            links += name == "a"
    flush()
    root.sign()
    return root


# Words of class, id and role by which authors mark what is not the article.
AWAY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored sponsors promo promotion promoted banner sidebar sidebars aside rail menu menus nav navbar navi navigation topbar toolbar "
    "breadcrumb breadcrumbs footer foot masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox newsletter subscribe subscription signup login signin register paywall "
    "share sharing shares sharebar social follow related recommended recommendations recirc teasers outbrain taboola trending popular comment comments commentlist reply replies respond responses disqus discussion reactions "
    "widget widgets pagination pager skip copyright complementary contentinfo search form dialog alertdialog toc colophon disclaimer".split()
)
AWAY_NAMES = frozenset("head nav footer aside form button select datalist label legend fieldset output dialog menu noscript svg math canvas object audio video search".split())
