"""A document tree as Markdown (CommonMark with pipe tables)."""

from __future__ import annotations

import re

from pagemill.documents.address import resolve
from pagemill.documents.dom import BLOCKS, Node, one_line
from pagemill.documents.tables import cell_text

_ESCAPED = re.compile(r"([\\`*_\[\]])")
_LINE_START = re.compile(r"(?m)^(\s*)(#{1,6}(?=\s)|[-+](?=\s)|>|(\d+)([.)])(?=\s))")
_SPACES = re.compile("[ \t\n\r\f]+")
_BLANKS = re.compile(r"\n{3,}")
SKIPPED = frozenset("script style noscript template head title meta link iframe object svg button input select textarea".split())
_CONTAINERS = BLOCKS | frozenset("body html tr td th thead tbody tfoot li dt dd caption figcaption".split()) | {""}


def _escape(text: str, keep: re.Pattern | None) -> str:
    if keep is None:
        return _ESCAPED.sub(r"\\\1", text)
    out, at = [], 0
    for m in keep.finditer(text):
        out += [_ESCAPED.sub(r"\\\1", text[at : m.start()]), m[0]]
        at = m.end()
    return "".join(out) + _ESCAPED.sub(r"\\\1", text[at:])


class Writer:
    """``base`` resolves addresses; ``keep`` matches marks in texts that aren't escaped; images are written only if ``images``."""

    def __init__(self, base: str = "", keep: re.Pattern | None = None, images: bool = False):
        self.base, self.keep, self.images = base, keep, images

    def inline(self, nodes: list[Node], depth: int = 0) -> str:
        out: list[str] = []
        for n in nodes:
            if n.tag is None:
                out.append(_escape(_SPACES.sub(" ", n.text), self.keep))
            elif n.tag in SKIPPED or depth > 200:
                continue
            elif n.tag == "br":
                out.append("  \n")
            elif n.tag == "img":
                src = resolve(n.get("src"), self.base) if self.images else ""
                out.append(f"![{_escape(one_line(n.get('alt')), None)}]({src})" if src else "")
            elif n.tag in ("code", "kbd", "samp", "tt"):
                text = _SPACES.sub(" ", n.words()).strip()
                fence = "`" * (max(map(len, re.findall("`+", text)), default=0) + 1)
                pad = " " if text.startswith("`") or text.endswith("`") else ""
                out.append(f"{fence}{pad}{text}{pad}{fence}" if text else "")
            else:
                inner = self.inline(n.children, depth + 1)
                core = inner.strip()
                lead, trail = (" " if inner[:1].isspace() else ""), (" " if inner[-1:].isspace() else "")
                if not core:
                    out.append(" " if inner else "")
                elif n.tag in ("b", "strong"):
                    out.append(f"{lead}**{core}**{trail}")
                elif n.tag in ("i", "em", "cite", "dfn"):
                    out.append(f"{lead}*{core}*{trail}")
                elif n.tag in ("s", "strike", "del"):
                    out.append(f"{lead}~~{core}~~{trail}")
                elif n.tag == "a" and n.get("href").strip():
                    href = resolve(n.get("href").strip(), self.base) or n.get("href").strip()
                    out.append(f"{lead}[{core}]({href.replace(' ', '%20').replace(')', '%29')}){trail}")
                else:
                    out.append(inner)
        return "".join(out)

    def _text(self, nodes: list[Node]) -> str:
        lines = [re.sub(" +", " ", x).strip() for x in self.inline(nodes).split("  \n")]
        text = "  \n".join(lines).strip()
        return _LINE_START.sub(lambda m: m[1] + (f"{m[3]}\\{m[4]}" if m[3] else "\\" + m[2]), text)

    def blocks(self, n: Node, depth: int = 0) -> list[str]:
        """The blocks of a node's content, one text for each."""
        out: list[str] = []
        run: list[Node] = []

        def flush() -> None:
            if run and (text := self._text(run)):
                out.append(text)
            run.clear()

        for c in n.children:
            if c.tag in SKIPPED:
                continue
            if c.tag is None or c.tag not in _CONTAINERS and not self._holds_blocks(c):
                run.append(c)
                continue
            flush()
            out += self.block(c, depth + 1)
        flush()
        return out

    @staticmethod
    def _holds_blocks(n: Node) -> bool:
        return any(x.tag in _CONTAINERS for x in n.walk() if x is not n)

    def block(self, n: Node, depth: int) -> list[str]:
        if depth > 200:
            text = _escape(one_line(n.words()), self.keep)
            return [text] if text else []
        if n.tag[0] == "h" and n.tag[1:].isdigit():
            text = one_line(self._text(n.children))
            return [f"{'#' * int(n.tag[1:])} {text}"] if text else []
        if n.tag == "hr":
            return ["* * *"]
        if n.tag == "pre":
            text = n.words().strip("\n")
            code = next(n.all("code"), n)
            m = re.search(r"(?:language|lang)-(\S+)", code.get("class"))
            fence = "`" * max(3, max(map(len, re.findall("`+", text)), default=0) + 1)
            return [f"{fence}{m[1] if m else ''}\n{text}\n{fence}"] if text.strip() else []
        if n.tag == "blockquote":
            text = "\n\n".join(self.blocks(n, depth))
            return ["\n".join(f"> {x}".rstrip() for x in text.split("\n"))] if text else []
        if n.tag in ("ul", "ol", "menu", "dir"):
            return self._list(n, depth)
        if n.tag == "table":
            return self._table(n, depth)
        return self.blocks(n, depth)

    def _list(self, n: Node, depth: int) -> list[str]:
        items, no = [], 1
        if n.tag == "ol" and n.get("start").strip().isdigit():
            no = int(n.get("start"))
        for c in n.children:
            if c.tag is None or c.tag in SKIPPED:
                continue
            parts = self.blocks(c, depth) if c.tag not in ("ul", "ol") else self._list(c, depth)
            if not parts:
                continue
            mark = f"{no}. " if n.tag == "ol" else "- "
            no += 1
            loose = any(x.tag == "p" for x in c.children)
            text = ("\n\n" if loose else "\n").join(parts)
            items.append(mark + text.replace("\n", "\n" + " " * len(mark)))
        return [re.sub(r"(?m)^ +$", "", "\n".join(items))] if items else []

    def _table(self, table: Node, depth: int) -> list[str]:
        """A regular table with its spans filled by their text; one for layout as the blocks of its cells."""
        rows = [tr for tr in table.all("tr") if tr.up("table", 4) is table]
        plain = table.get("role").lower() not in ("presentation", "none") and not any(True for _ in table.all("table"))
        cells: list[list[str]] = []
        spans: dict[tuple[int, int], str] = {}
        for r, tr in enumerate(rows if plain else []):
            line: list[str] = []
            for c in (x for x in tr.children if x.tag in ("td", "th")):
                while (r, len(line)) in spans:
                    line.append(spans[r, len(line)])
                text = cell_text(c)
                size = lambda k: min(max(1, int(c.get(k))), 100) if c.get(k).strip().isdigit() else 1  # noqa: E731, B023
                for k in range(size("colspan")):
                    for below in range(1, size("rowspan")):
                        spans[r + below, len(line)] = text
                    line.append(text)
            while (r, len(line)) in spans:
                line.append(spans[r, len(line)])
            if line:
                cells.append(line)
        wide = max(map(len, cells), default=0)
        if len(cells) < 2 or wide < 2:
            return [b for tr in rows for c in tr.children if c.tag in ("td", "th") for b in self.blocks(c, depth + 1)]
        full = ["| " + " | ".join(x + [""] * (wide - len(x))) + " |" for x in cells]
        text = "\n".join([full[0], "|" + " --- |" * wide, *full[1:]])
        cap = next((one_line(x.words()) for x in table.all("caption")), "")
        return [_escape(cap, self.keep), text] if cap else [text]


def to_markdown(root: Node, base: str = "", keep: re.Pattern | None = None, images: bool = False) -> str:
    w = Writer(base, keep, images)
    top = Node("")
    top.children = [root] if root.tag else root.children
    return _BLANKS.sub("\n\n", "\n\n".join(w.blocks(top))).strip()
