"""Web pages as trees of block elements: a tolerant reader of HTML for pages of any length.

Elements that only style words are left out of the tree, their text belongs to the block around them. A tree node is
``[label, name, kids]``, a kid a node or ``(text, in_link)``; a label is the element's name with its classes, id and
role, digits as 0.
"""

import re
from functools import lru_cache
from html import unescape

# Fixed values of the HTML format.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr td th".split())
IN_HEAD = frozenset("base link meta script style title noscript template".split())
#: An element in the key ends one of these names that is still open.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tbody": ("tr", "thead", "tbody", "tfoot"), "thead": ("tr", "thead", "tbody"), "tfoot": ("tr", "thead", "tbody")}
SCOPES = frozenset("html body table td th ul ol dl div section article main aside nav header footer form button object template select".split())

# Names and words that mark what is no article: plain lists, judged by whole words of class, id and role.
OUT_NAMES = frozenset(
    "head title nav footer aside form script style noscript template iframe object embed applet svg canvas button "
    "select textarea input fieldset dialog menu audio video map noembed noframes xmp".split())
OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored sponsors promo promos "
    "promotion nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager footer sidebar sidebars aside "
    "complementary contentinfo related recommended recommendations share sharing social comment comments commentlist "
    "replies reply respond responses discussion disqus cookie cookies consent gdpr notice notices notification "
    "notifications alert popup modal overlay newsletter subscribe subscription signup login search searchbox toolbar "
    "skip copyright disclaimer dialog form masthead widget widgets".split())
HEADER_WORDS = frozenset("header masthead topbar".split())

#: Elements nested deeper belong to the one at this depth.
DEEPEST = 150

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_MARKS = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


def tokens(html: str):
    """``(text,)`` and ``(closes, name, attributes)`` of a page; comments and raw contents are skipped."""
    at, start, tag, size = 0, 0, _TAG, len(html)
    while (lt := html.find("<", at)) >= 0:
        mark = html[lt + 1:lt + 2]
        if mark.isascii() and mark.isalpha() or mark == "/" and html[lt + 2:lt + 3].isascii() and html[lt + 2:lt + 3].isalpha():
            found = tag.match(html, lt)
            if found is None and tag is _TAG:  # an open quote: from here on a tag ends at the next >
                tag = _LOOSE
                found = tag.match(html, lt)
            if start < lt:
                yield (html[start:lt],)
            if found is None:  # a tag that the page's end cuts off
                return
            closes, name, rest = found.groups()
            name = name.lower()
            yield closes, name, rest
            at = found.end()
            if name in RAW and not closes:
                end = _RAW_END[name].search(html, at)
                at = end.end() if end else size
                yield "/", name, ""
            start = at
        elif mark == "!" or mark == "?" or mark == "/":
            if start < lt:
                yield (html[start:lt],)
            comment = html.startswith("<!--", lt)
            end = html.find("-->" if comment else ">", lt + 2)
            at = start = size if end < 0 else end + (3 if comment else 1)
        else:
            at = lt + 1
    if start < size:
        yield (html[start:],)


def label(name: str, rest: str) -> str:
    if not rest:
        return name
    marks = {}
    for found in _MARKS.finditer(rest):
        marks.setdefault(found[1].lower(), found[2] or found[3] or found[4] or "")
    if not marks:
        return name
    made = name
    for mark, sign in (("class", "."), ("id", "#"), ("role", "@"), ("itemprop", "%")):
        if words := marks.get(mark, "").lower().split():
            made += sign + sign.join(sorted(set(words)))
    return _DIGITS.sub("0", made).replace(">", "")


def name_of(label_: str) -> str:
    return re.split(r"[.#@%]", label_, maxsplit=1)[0]


def marks_of(label_: str) -> set[str]:
    return set(_WORD.findall(label_[len(name_of(label_)):]))


@lru_cache(maxsize=20_000)
def is_article(label_: str) -> bool:
    return name_of(label_) == "article" and not marks_of(label_) & OUT_WORDS or "articlebody" in label_


@lru_cache(maxsize=20_000)
def is_main(label_: str) -> bool:
    return name_of(label_) == "main" or "@main" in label_


@lru_cache(maxsize=20_000)
def is_out(label_: str) -> bool:
    """Whether an element is no part of an article by its name, class, id or role."""
    name = name_of(label_)
    if name in OUT_NAMES:
        return True
    return name not in ("html", "body", "main") and bool(marks_of(label_) & OUT_WORDS)


@lru_cache(maxsize=20_000)
def is_header(label_: str) -> bool:
    """A header: left out, but for that of an article."""
    return name_of(label_) == "header" or name_of(label_) not in ("html", "body") and bool(marks_of(label_) & HEADER_WORDS)


class _Labels(dict):
    """Label of a tag and whether an inline one is left out; forgotten when too many are known."""

    def __missing__(self, key):
        if len(self) > 50_000:
            self.clear()
        made = label(*key)
        self[key] = made, is_out(made)
        return self[key]


_known = _Labels()


def tree(html: str) -> list:
    """The root node of a page."""
    root = ["", "", []]
    stack, links, known = [root], 0, _known
    for token in tokens(html):
        if len(token) == 1:
            stack[-1][2].append((token[0], links > 0))
            continue
        closes, name, rest = token
        if name == "a":
            links = max(0, links - 1) if closes else links + 1
        if closes:
            if name in INLINE and stack[-1][1] != name:
                if name in ("td", "th"):
                    stack[-1][2].append((" ", False))
                continue
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][1] == name:
                    if name not in ("body", "html"):
                        del stack[at:]
                        links = 0
                    break
            continue
        made, out = known[name, rest]
        if name in INLINE and not out:
            if name in ("td", "th"):
                stack[-1][2].append((" ", False))
            continue
        if name == "br":
            stack[-1][2].append((" ", links > 0))
            continue
        if name in VOID:
            if name == "hr":
                stack[-1][2].append([made, name, []])
            continue
        if name not in INLINE:
            # What this element ends: an open paragraph, or an item of its kind.
            ended = ENDS.get(name, ())
            for at in range(len(stack) - 1, 0, -1):
                open_ = stack[at][1]
                if open_ == "p" or open_ in ended:
                    del stack[at:]
                    links = 0
                    if open_ == "p":
                        continue
                elif open_ == "head" and name not in IN_HEAD:
                    del stack[at:]
                elif open_ in SCOPES:
                    break
        if name in ("html", "body") and any(n[1] == name for n in stack):
            continue
        node = [made, name, []]
        stack[-1][2].append(node)
        if len(stack) < DEEPEST:
            stack.append(node)
    return root


def clean(text: str) -> str:
    return " ".join((unescape(text) if "&" in text else text).split())
