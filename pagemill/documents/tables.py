"""Data tables of a document as pipe tables."""

from __future__ import annotations

import re

from pagemill.documents.dom import Node, one_line, trim

# Limits, class names of tables that hold no data, notes.
MAX_ROWS, MAX_TABLES = 50, 12
NO_DATA = ("infobox", "navbox", "vertical-navbox", "sidebar", "metadata", "ambox", "mbox", "toccolours", "plainlinks")
CAPPED = "\n\n*(table truncated to the first {} of {} rows; the rest are not reachable via offset — use web_fetch_raw for the full table)*"

_RULE = re.compile(r"(?m)^\s*\|(?=[^\n]*-)[|\-: ]*\s*$")


def has_pipe_table(markdown: str) -> bool:
    """Whether a line is the rule below a pipe table's header."""
    return _RULE.search(markdown) is not None


def is_data_table(table: Node) -> bool:
    """Whether a table holds data: header cells, three rows and four cells at least, and neither role nor class against it."""
    if table.get("role").lower() in ("presentation", "none"):
        return False
    kind = table.get("class").lower()
    if any(name in kind for name in NO_DATA):
        return False
    counts = dict.fromkeys(("th", "tr", "td"), 0)
    for n in table.all("th", "tr", "td"):
        counts[n.tag] += 1
    return counts["th"] > 0 and counts["tr"] >= 3 and counts["td"] >= 4


def cell_text(cell: Node) -> str:
    """A cell on one line: its texts joined by spaces, pipes escaped; images say nothing."""
    return one_line(" ".join(t for n in cell.walk() if n.tag is None and (t := trim(n.text)))).replace("|", "\\|")


def grid(table: Node) -> list[list[str]]:
    """The cells of the table's own rows; tables within it are left out."""
    rows, stack = [], list(reversed(table.children))
    while stack:
        n = stack.pop()
        if n.tag == "tr":
            if cells := [cell_text(c) for c in n.children if c.tag in ("td", "th")]:
                rows.append(cells)
        elif n.tag != "table":
            stack.extend(reversed(n.children))
    return rows


def pipe_table(rows: list[list[str]], limit: int = MAX_ROWS) -> str:
    """Rows as a pipe table, the first as its header, short ones filled up; '' for less than two rows or columns."""
    wide = max(map(len, rows), default=0)
    if len(rows) < 2 or wide < 2:
        return ""
    line = lambda cells: "| " + " | ".join(cells + [""] * (wide - len(cells))) + " |"
    out = [line(rows[0]), "|" + " --- |" * wide, *map(line, rows[1 : limit + 1])]
    return "\n".join(out) + (CAPPED.format(limit, len(rows) - 1) if len(rows) - 1 > limit else "")


def caption(table: Node) -> str:
    found = next(table.all("caption"), None)
    return one_line(found.words()) if found else ""


def data_tables(root: Node) -> list[tuple[str, list[list[str]]]]:
    """(caption, cells) of the data tables in order; what stands within one isn't looked at again."""
    found, stack = [], [root]
    while stack:
        n = stack.pop()
        if n.tag == "table" and is_data_table(n):
            found.append((caption(n), grid(n)))
        else:
            stack.extend(reversed(n.children))
    return found


def table_section(root: Node) -> str:
    """The document's data tables under one heading, or ''."""
    shown: list[str] = []
    for name, rows in data_tables(root):
        if len(shown) == MAX_TABLES:
            break
        if text := pipe_table(rows):
            shown.append(f"\n### {name or f'Table {len(shown) + 1}'}\n\n{text}\n")
    return "\n\n## Tables\n" + "".join(shown) if shown else ""
