"""The main content of a document, by scoring paragraphs and their containers."""

from __future__ import annotations

import re

from pagemill.documents.dom import Node, one_line

# Names of classes and ids that speak for or against main content.
UNLIKELY = re.compile(r"-ad-|ai2html|banner|breadcrumbs|combx|comment|community|cover-wrap|disqus|extra|footer|gdpr|header|legends|menu|related|remark|replies|rss|shoutbox|sidebar|skyscraper|social|sponsor|supplemental|ad-break|agegate|pagination|pager|popup|yom-remote", re.I)
MAYBE = re.compile(r"and|article|body|column|content|main|mathjax|shadow", re.I)
GOOD = re.compile(r"article|body|content|entry|hentry|h-entry|main|page|pagination|post|text|blog|story", re.I)
BAD = re.compile(r"-ad-|hidden|banner|combx|comment|com-|contact|footer|gdpr|masthead|media|meta|outbrain|promo|related|scroll|share|shoutbox|sidebar|skyscraper|sponsor|shopping|tags|widget", re.I)
UNLIKELY_ROLES = frozenset("menu menubar complementary navigation alert alertdialog dialog".split())

DROPPED = frozenset("script style noscript template iframe object embed form button input select textarea nav aside footer header link meta svg".split())
SCORED = frozenset("p td pre section h2 h3 h4 h5 h6 blockquote li dd".split())
#: What a container's kind is worth before its paragraphs.
KINDS = {"article": 10, "div": 5, "main": 8, "pre": 3, "td": 3, "blockquote": 3, "address": -3, "ol": -3, "ul": -3, "dl": -3, "dd": -3, "dt": -3, "li": -3, "form": -3, "h1": -5, "h2": -5, "h3": -5, "h4": -5, "h5": -5, "h6": -5, "th": -5}
#: Characters from which a paragraph counts, and from which a document's text is content at all.
PARAGRAPH, CONTENT = 25, 25


def _names(n: Node) -> str:
    return f"{n.get('class')} {n.get('id')}"


def _weight(n: Node) -> int:
    names = _names(n)
    return (25 if GOOD.search(names) else 0) - (25 if BAD.search(names) else 0)


def _hidden(n: Node) -> bool:
    return any(k == "hidden" for k, _ in n.attrs) or n.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", n.get("style"), re.I) is not None


def prune(root: Node, lenient: bool = False) -> None:
    """Takes out what can't be main content; ``lenient`` leaves what only its name speaks against."""
    for n in list(root.walk()):
        if n.tag is None or n.tag in ("", "html", "body"):
            continue
        inside = n.up("article", 1000) is not None or n.up("main", 1000) is not None
        out = n.tag in DROPPED and not (n.tag == "header" and inside and any(True for _ in n.all("h1", "h2")))
        names = _names(n)
        out = out or _hidden(n) or n.get("role").lower() in UNLIKELY_ROLES
        if not lenient and not out and n.tag not in ("a", "article", "main", "table", "tr", "td", "th", "code"):
            out = UNLIKELY.search(names) is not None and MAYBE.search(names) is None and n.up("table", 3) is None and n.up("code", 3) is None
        if out:
            n.remove()


def link_density(n: Node) -> float:
    total = len(one_line(n.words()))
    linked = sum(len(one_line(a.words())) * (0.3 if a.get("href").startswith("#") else 1) for a in n.all("a"))
    return linked / total if total else 0.0


def densities(root: Node) -> dict[int, float]:
    """``link_density`` of every element below ``root`` by identity, from one pass over the tree; text nodes count without outer white space."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += n.children
    total: dict[int, float] = {}
    linked: dict[int, float] = {}
    for n in reversed(order):
        if n.tag is None:
            total[id(n)], linked[id(n)] = len(one_line(n.text)), 0.0
            continue
        total[id(n)] = sum(total[id(c)] for c in n.children)
        linked[id(n)] = total[id(n)] * (0.3 if n.get("href").startswith("#") else 1) if n.tag == "a" else sum(linked[id(c)] for c in n.children)
    return {k: linked[k] / t if t else 0.0 for k, t in total.items()}


def _paragraph_like(n: Node) -> bool:
    """A division without blocks of its own is a paragraph."""
    return n.tag == "div" and not any(c.tag in KINDS or c.tag in ("p", "table", "section", "figure", "ul", "ol", "dl") for c in n.children)


def scores(root: Node) -> dict[int, tuple[Node, float]]:
    """Containers by identity with their scores: each paragraph counts in full for its parent, half for its grandparent, a third of the half beyond."""
    found: dict[int, list] = {}
    for n in root.walk():
        if n.tag not in SCORED and not (n.tag is not None and _paragraph_like(n)):
            continue
        text = one_line(n.words())
        if len(text) < PARAGRAPH:
            continue
        points = 1 + sum(text.count(c) for c in ",،、，﹐︐") + min(len(text) // 100, 3)
        up, level = n.parent, 0
        while up is not None and up.tag not in (None, "") and level < 5:
            if id(up) not in found:
                found[id(up)] = [up, KINDS.get(up.tag, 0) + _weight(up)]
            found[id(up)][1] += points / (1 if level == 0 else 2 if level == 1 else level * 3)
            up, level = up.parent, level + 1
    density = densities(root)
    return {k: (n, s * (1 - density.get(k, density[id(root)]))) for k, (n, s) in found.items()}


def _siblings(top: Node, scored: dict[int, tuple[Node, float]], best: float) -> Node:
    """The best container with those beside it that are content, too."""
    out = Node("div")
    if top.parent is None or top.parent.tag in ("", "html"):
        return top
    threshold = max(10.0, 0.2 * best)
    for c in list(top.parent.children):
        keep = c is top
        if not keep and c.tag is not None:
            bonus = 0.2 * best if top.get("class") and c.get("class") == top.get("class") else 0
            keep = scored.get(id(c), (c, 0.0))[1] + bonus >= threshold
            if not keep and c.tag == "p":
                text, density = one_line(c.words()), link_density(c)
                keep = len(text) > 80 and density < 0.25 or 0 < len(text) <= 80 and density == 0 and re.search(r"\.(?: |$)", text) is not None
            keep = keep or c.tag in ("h1", "h2") and any(x is top for x in top.parent.children[top.parent.children.index(c) : top.parent.children.index(c) + 3])
        if keep:
            out.add(c)
    return out


def _clean(content: Node) -> None:
    """Takes out of the content what is mostly links or names itself as something else."""
    for n in list(content.walk()):
        if n is content or n.tag not in ("div", "ul", "ol", "section", "fieldset", "table"):
            continue
        if n.tag == "table" and any(True for _ in n.all("th", "caption")):
            continue
        text, density = one_line(n.words()), link_density(n)
        images = sum(1 for _ in n.all("img"))
        if images or n.up("figure", 3) is not None:
            continue
        weight = _weight(n)
        paragraphs = sum(1 for _ in n.all("p"))
        if weight < 0 and len(text) < 400 or density > 0.5 and weight < 25 and len(text) < 2000 or not text or n.tag in ("ul", "ol") and density > 0.2 + 0.3 * (weight > 0) and paragraphs == 0 and len(text) < 500 and density > 0.33:
            n.remove()


def document_title(root: Node) -> str:
    for wanted in (("meta", "og:title"), ("title", "")):
        for n in root.all(wanted[0]):
            if n.tag == "meta" and (n.get("property").lower() or n.get("name").lower()) != wanted[1]:
                continue
            if t := one_line(n.get("content") if n.tag == "meta" else n.words()):
                return t
    return ""


def main_content(root: Node) -> tuple[str, Node | None]:
    """(title, the main content's subtree or None). Takes ``root`` apart.

    One article or main element that holds most of the text is the content;
    otherwise the best-scored container with its siblings is.
    """
    title = document_title(root)
    body = next(root.all("body"), root)
    prune(body)
    whole = len(one_line(body.words()))
    if whole < CONTENT:
        return title, None
    for n in body.all("article", "main"):
        if len(one_line(n.words())) >= 0.5 * whole and len(one_line(n.words())) >= CONTENT:
            _clean(n)
            return title, n
    scored = scores(body)
    if not scored:
        return title, body
    top, best = max(scored.values(), key=lambda x: x[1])
    content = _siblings(top, scored, best)
    _clean(content)
    return title, content if len(one_line(content.words())) >= CONTENT else body
