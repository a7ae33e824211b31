"""Blocks of text of a page, in page order, with their place in the tree of elements."""

import re
from dataclasses import dataclass
from html import unescape

# Tags that begin or end a block. All others are part of the text they stand in.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p"
    " pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content isn't text of the page: all up to their end tag is passed over.
UNSEEN_TAGS = frozenset("script style title textarea noscript template iframe object svg math canvas audio video".split())
# A start tag of these ends an open element of the same kind, or a paragraph.
SIBLING_TAGS = frozenset("li dt dd tr td th option p".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog button select fieldset label search".split())
# Words in class, id and role that mark what is not the article.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices alert popup modal overlay sidebar sidenav aside nav navbar navigation menu menubar breadcrumb"
    " breadcrumbs pagination pager footer contentinfo masthead topbar toolbar share sharing social related recommended"
    " recommendations teaser teasers trending comment comments commentlist discussion replies reply respond disqus"
    " newsletter subscribe subscription signup login register search widget copyright disclaimer complementary dialog"
    " paywall".split()
)
CONTENT_WORDS = frozenset("article articlebody post entry story content main".split())
# With one of these a name says how a page is laid out, not what an element holds.
LAYOUT_WORDS = frozenset("has with no without hide show toggle".split())

CONTENT, MAYBE, UNKNOWN, BOILERPLATE = "content", "maybe", "unknown", "boilerplate"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)>?|<[!?/][^>]*>?", re.S
)
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|[\s\"'])(?:hidden(?=\s|$|=|/)|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in UNSEEN_TAGS}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    """``parent`` and ``grandparent`` number elements of the page; ``cue`` is what its elements say."""

    text: str
    tag: str
    cue: str
    parent: int
    grandparent: int
    linked: int


def named_cue(attributes: str) -> str:
    """What class, id and role of an element say about it."""
    found = UNKNOWN
    for kind, value in _NAMES.findall(attributes):
        for name in value.strip("\"'").split():
            words = {w.lower() for w in _WORD.findall(name)} | {name.lower()}
            if words & LAYOUT_WORDS:
                continue
            if words & BOILERPLATE_WORDS:
                return BOILERPLATE
            if "header" in words:
                found = found if words & CONTENT_WORDS else BOILERPLATE
                if found == BOILERPLATE:
                    return found
            elif kind.lower() == "itemprop" and name.lower() == "articlebody":
                found = CONTENT
            elif words & CONTENT_WORDS and found == UNKNOWN:
                found = MAYBE
    return BOILERPLATE if _HIDDEN.search(attributes) else found


def page_blocks(html: str | None) -> list[Block]:
    """All blocks with text. Character references are decoded once; white space becomes one
    space. Unclosed, truncated and wrongly nested tags are taken as browsers mostly take them."""
    html = html or ""
    blocks: list[Block] = []
    # Open block elements: tag, number, cue; the page itself is at the bottom.
    stack = [("", 0, UNKNOWN)]
    pieces: list[str] = []
    linked: list[str] = []
    links, number, at = 0, 0, 0
    articles = 0

    def close_block():
        nonlocal pieces, linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                tag, own, cue = stack[-1]
                if tag in HEADINGS and cue == "headline":
                    cue = CONTENT
                elif cue == "headline":
                    cue = BOILERPLATE
                parent = stack[-2][1] if len(stack) > 1 else own
                above = stack[-3][1] if len(stack) > 2 else parent
                # Paragraphs and the like stand in their parent; other elements hold text of their own.
                if tag not in SIBLING_TAGS and tag not in HEADINGS:
                    parent, above = own, parent
                blocks.append(Block(text, tag, cue, parent, above, len("".join(linked))))
            pieces, linked = [], []

    def pop():
        nonlocal articles
        tag = stack.pop()[0]
        articles -= tag == "article"

    while True:
        match = _TOKEN.search(html, at)
        text = html[at : match.start()] if match else html[at:]
        if text:
            pieces.append(text)
            if links:
                linked.append(text)
        if not match:
            break
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK_TAGS:
                close_block()
                if any(open_tag == tag for open_tag, _, _ in stack):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
            continue
        if tag in UNSEEN_TAGS:
            end = _ENDS[tag].search(html, at)
            at = end.start() if end else len(html)
            continue
        if tag == "a":
            links += 1
        elif tag == "br":
            pieces.append(" ")
        if tag not in BLOCK_TAGS:
            continue
        close_block()
        links = 0
        if stack[-1][0] == "p" or (stack[-1][0] == tag and tag in SIBLING_TAGS):
            pop()
        if tag in VOID_TAGS:
            continue
        number += 1
        inherited, attributes = stack[-1][2], match[3] or ""
        named = UNKNOWN if tag in ("html", "body", "head") else named_cue(attributes) if attributes else UNKNOWN
        in_form = inherited == BOILERPLATE and any(t == "form" for t, _, _ in stack)
        if inherited in (BOILERPLATE, "headline") and not (tag in ("article", "main") and in_form):
            cue = inherited
        elif named == BOILERPLATE or tag in BOILERPLATE_TAGS:
            cue = BOILERPLATE
        elif tag == "article":
            # An article in an article is a comment on it or a pointer to another one.
            cue = BOILERPLATE if articles else CONTENT
        elif tag == "header":
            cue = "headline" if inherited in (CONTENT, MAYBE) else BOILERPLATE
        elif named == CONTENT or inherited == CONTENT:
            cue = CONTENT
        elif tag == "main" or named == MAYBE:
            cue = MAYBE
        else:
            cue = inherited
        articles += tag == "article"
        stack.append((tag, number, cue))
    close_block()
    return blocks
