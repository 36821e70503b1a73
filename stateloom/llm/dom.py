"""A small tolerant reader of html: a folded tree of blocks, and simple tree matching of such trees."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names by what they mean for the text.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = set("br hr".split())  # void elements that end a block; the others stand within a line or show nothing
RAW = "script style noscript template iframe textarea svg math object select button canvas audio video".split()
ASIDE_TAGS = set("nav header footer aside form menu dialog head title".split())
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice alert newsletter"
    " subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments respond"
    " disqus share sharing social related popup modal login search widget toolbar pagination pager form"
    " complementary contentinfo dialog".split()
)
# words that may stand beside one of these in a class: site-footer, nav-menu, comments-area; not no-sidebar
BESIDE_ASIDE = set("site page main top bottom left right primary secondary global mobile area bar block box container wrapper wrap inner section list links slot unit item items group buttons icons posts signup thread message".split())
# words of reader comments, and what may stand beside these only: post-comments, not post-header
COMMENT_WORDS = set("comment comments respond disqus".split())
BESIDE_COMMENTS = set("post user reader readers article".split())
NEVER_ASIDE = set("page html body main article".split())
CLOSED_BY = {"p": set("p".split()), "li": set("li".split()), "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

MAX_DEPTH = 100  # deeper elements count as children of the element at this depth

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
BLANKS = re.compile(r"\s+")


@dataclass
class Node:
    label: str
    children: list[Node] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)


def is_aside(label: str) -> bool:
    """Whether a label (tag.word.word) is that of a menu, advert, form or the like."""
    tag, *words = label.split(".")
    return tag in ASIDE_TAGS or (tag not in NEVER_ASIDE and any(names_aside(w) for w in words))


def names_aside(word: str) -> bool:
    """Whether a whole class word says so: one of its parts, and no part that says otherwise."""
    parts = set(word.split("-"))
    beside = BESIDE_ASIDE | BESIDE_COMMENTS if parts & COMMENT_WORDS else BESIDE_ASIDE
    return bool(parts & ASIDE_WORDS) and parts <= ASIDE_WORDS | beside


def label_of(tag: str, attrs: str) -> str:
    words: list[str] = []
    if attrs:
        for _, a, b, c in ATTRIBUTE.findall(attrs):
            words += ["-".join(parts) for w in (a or b or c).lower().split() if (parts := re.findall(r"[a-z]+", w))]
    return ".".join([tag, *dict.fromkeys(words)])


def read(page: str) -> tuple[Node, list[str]]:
    """The tree of block elements and the blocks in page order. Inline elements leave no trace unless set aside."""
    root, texts = Node("page"), []
    stack, pending, at = [root], [], 0

    def flush() -> None:
        if pending:
            text = BLANKS.sub(" ", html.unescape("".join(pending))).strip()
            pending.clear()
            if text:
                stack[-1].blocks.append(len(texts))
                texts.append(text)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            pending.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if m["end"]:
            if inline and not any(n.label.split(".", 1)[0] == tag for n in stack[1:]):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].label.split(".", 1)[0] == tag:
                    flush()
                    del stack[k:]
                    break
            continue
        label = label_of(tag, m["attrs"])
        if inline and not is_aside(label):
            continue
        if tag in VOID:
            if tag in BREAKS:
                flush()
            continue
        flush()
        if tag in CLOSED_BY and stack[-1].label.split(".", 1)[0] in CLOSED_BY[tag]:
            stack.pop()
        elif not inline and len(stack) > 1 and stack[-1].label.split(".", 1)[0] == "p":
            stack.pop()
        node = Node(label)
        stack[-1].children.append(node)
        if len(stack) < MAX_DEPTH:
            stack.append(node)
    pending.append(page[at:])
    flush()
    return root, texts


def folded(node: Node) -> Node:
    """Neighbours with one label become one node with the children of all, at every level."""
    children: list[Node] = []
    for child in node.children:
        if children and children[-1].label == child.label:
            children[-1].children.extend(child.children)
            children[-1].blocks.extend(child.blocks)
        else:
            children.append(Node(child.label, list(child.children), list(child.blocks)))
    node.children = [folded(c) for c in children]
    return node


def preorder(node: Node, depth: int = 0):
    yield depth, node
    for child in node.children:
        yield from preorder(child, depth + 1)


def written(node: Node) -> str:
    return "\n".join(f"{depth} {n.label}" for depth, n in preorder(node))


def parsed(shape: str) -> Node:
    stack: list[Node] = []
    for line in shape.split("\n"):
        depth, label = line.split(" ", 1)
        node = Node(label)
        del stack[int(depth) :]
        if stack:
            stack[-1].children.append(node)
        stack.append(node)
    return stack[0]


def matching(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the largest number of nodes that can be paired in order, root with root; and the pairs."""
    if a.label != b.label:
        return 0, []
    n, m = len(a.children), len(b.children)
    below = {(i, j): matching(x, y) for i, x in enumerate(a.children) for j, y in enumerate(b.children) if x.label == y.label}
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            pair = below[i - 1, j - 1][0] if (i - 1, j - 1) in below else 0
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + pair)
    pairs, i, j = [(a, b)], n, m
    while i and j:
        pair = below[i - 1, j - 1][0] if (i - 1, j - 1) in below else 0
        if pair and best[i][j] == best[i - 1][j - 1] + pair:
            pairs += below[i - 1, j - 1][1]
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[n][m] + 1, pairs


def merge(wrapper: Node, other: Node) -> Node:
    """`wrapper` with the nodes of `other` that found no partner inserted where they stand."""
    partner = {id(b): a for a, b in matching(wrapper, other)[1]}

    def insert(b: Node) -> None:
        a, place = partner[id(b)], 0
        for child in b.children:
            if id(child) in partner:
                place = next(k for k, x in enumerate(a.children) if x is partner[id(child)]) + 1
                insert(child)
            else:
                a.children.insert(place, child)
                place += 1

    insert(other)
    return wrapper
