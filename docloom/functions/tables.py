"""The post-cleaner: marks on lines of their own, page numbers, tables over page ends, rows outside tables."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from docloom.functions.folds import outside_tables, per_text, with_end

START, END = "[[TABLE_START ", "[[TABLE_END]]"
_MARK = r"\[\[(?:PAGE_START |TABLE_START )(?:(?!\]\])[^\n])*\]\]|\[\[PAGE_END[^\n]{0,2}+|\[\[TABLE_END\]\]"
_AFTER, _BEFORE = re.compile(rf"({_MARK})(?!{_MARK})"), re.compile(rf"(?<=[^\n])(?={_MARK})")


def marks_on_lines(text: str) -> str:
    """Every page and table mark on a line of its own, an empty line after it; texts and blanks beside it stay as they are."""
    return _BEFORE.sub("\n", _AFTER.sub(r"\1\n", text)) + ("\n" if text.endswith("\n") else "")


def is_digits(line: str) -> bool:
    x = line.strip()
    return x.isdigit() and len(x) <= 3


def without_page_numbers(text: str) -> str:
    """Lines of digits go where the text before them is a page start, or after them a page end or table; both are sought outside tables, up to the next table."""

    def chunk(part: str) -> str:
        lines = part.splitlines()
        before, after = [""] * len(lines), [""] * len(lines)
        for out, order in ((before, range(len(lines))), (after, range(len(lines) - 1, -1, -1))):
            last = ""
            for i in order:
                out[i], last = last, lines[i].strip() or last
        keep = [x for x, b, a in zip(lines, before, after) if not (is_digits(x) and (b.startswith("[[PAGE_START ") or a.startswith(("[[PAGE_END", START))))]
        return with_end(keep, part)

    return outside_tables(text, chunk)


def read_header(line: str) -> dict[str, int | str]:
    """key=value tokens of a table's first line; whole numbers as such."""
    if not line.startswith(START):
        return {}
    pairs = (x.split("=", 1) for x in line[len(START) :].rstrip("]").split() if "=" in x)
    return {k: int(v) if re.fullmatch(r"[+-]?\d+", v) else v for k, v in pairs}


# The keys that come first in a header, in this order.
FIRST_KEYS = ("page", "index", "rows", "cols")


def header(meta: dict) -> str:
    keys = [k for k in FIRST_KEYS if k in meta] + sorted(k for k in meta if k not in FIRST_KEYS)
    return f"[[TABLE_START {' '.join(f'{k}={meta[k]}' for k in keys)}]]"


def cells(row: str) -> list[str]:
    return [c.strip() for c in row.split("|")]


def columns(rows: list[str]) -> int | None:
    """Cells of the first row that has more than one; bars at its edges don't count."""
    return next((n for r in rows if (n := len(r.strip().strip("|").split("|"))) > 1), None)


def compatible(a: int | None, b: int | None) -> bool:
    """Whether numbers of columns are close enough for one table: unknown, at most two apart, or a quarter of the smaller."""
    return a is None or b is None or abs(a - b) <= 2 or (min(a, b) > 0 and 4 * abs(a - b) <= min(a, b))


@dataclass
class Segment:
    lines: list[str] = field(default_factory=list)
    table: bool = False

    @property
    def rows(self) -> list[str]:
        return self.lines[1:-1]

    def ignorable(self) -> bool:
        """Text that may stand between the parts of one table: blank, digits, or up to two short lines without a ((n))."""
        said = [x.strip() for x in self.lines if x.strip()]
        if self.table or any(re.search(r"\(\(\d+\)\)", x) for x in said):
            return False
        return all(map(is_digits, said)) or (len(said) < 3 and all(len(x) <= 100 for x in said))


def segments(lines: list[str]) -> list[Segment]:
    """Runs of text and table lines; each table is a segment, up to its end mark."""
    out: list[Segment] = []
    inside = False
    for x in lines:
        if inside:
            out[-1].lines.append(x)
            inside = not x.startswith(END)
            continue
        inside = x.startswith(START)
        if inside or not out or out[-1].table:
            out.append(Segment(table=inside))
        out[-1].lines.append(x)
    return out


def join_split_row(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    """The first row of b joins the last of a, cell by cell, if it has text only where that row has."""
    at = [i for i, x in enumerate(a) if x.strip()][-1:]
    to = [i for i, x in enumerate(b) if x.strip()][:1]
    if not at or not to:
        return a, b
    x, y = cells(a[at[0]]), cells(b[to[0]])
    n = max(len(x), len(y))
    x, y = x + [""] * (n - len(x)), y + [""] * (n - len(y))
    if not any(y) or any(v and not u for u, v in zip(x, y)):
        return a, b
    row = " | ".join(f"{u} {v}" if v else u for u, v in zip(x, y))
    return [*a[: at[0]], row, *a[at[0] + 1 :]], b[: to[0]] + b[to[0] + 1 :]


def _counted(first: str, rows: list[str]) -> str:
    meta = read_header(first)
    if not meta:
        return first
    meta["rows"] = len(rows)
    if (n := columns(rows)) is not None:
        meta["cols"] = n
    return header(meta)


def _table_at(parts: list[Segment], order: range) -> int | None:
    """The first table in an order, with nothing but ignorable text before it."""
    i = next((i for i in order if not parts[i].ignorable()), None)
    return i if i is not None and parts[i].table else None


def _width(t: Segment) -> int | None:
    got = read_header(t.lines[0]).get("cols")
    return got if isinstance(got, int) else columns(t.rows)


@dataclass
class Page:
    start: str
    body: list[str] = field(default_factory=list)
    end: str | None = None


def join_pages(a: Page, b: Page) -> bool:
    """The table that b begins with goes on the one that a ends with, if their columns fit."""
    pa, pb = segments(a.body), segments(b.body)
    i, j = _table_at(pa, range(len(pa) - 1, -1, -1)), _table_at(pb, range(len(pb)))
    if i is None or j is None or not compatible(_width(pa[i]), _width(pb[j])):
        return False
    top, more = join_split_row(pa[i].rows, pb[j].rows)
    rows = top + more
    pa[i].lines = [_counted(pa[i].lines[0], rows), *rows, pa[i].lines[-1]]
    del pb[j]
    a.body, b.body = ([x for s in parts for x in s.lines] for parts in (pa, pb))
    return True


def read_pages(text: str) -> tuple[list[str], list[Page], list[str]]:
    """The lines before the first page, the pages, and the lines outside pages after it."""
    pages: list[Page] = []
    before: list[str] = []
    after: list[str] = []
    inside = False
    for x in text.splitlines():
        if x.startswith("[[PAGE_START "):
            pages.append(Page(x))
            inside = True
        elif inside and x.startswith("[[PAGE_END"):
            pages[-1].end, inside = x, False
        else:
            (pages[-1].body if inside else after if pages or x.startswith("[[PAGE_END") else before).append(x)
    return before, pages, after


def write_pages(before: list[str], pages: list[Page], after: list[str]) -> list[str]:
    return [*before, *(x for p in pages for x in (p.start, *p.body, *([p.end] if p.end else []))), *after]


def join_tables(text: str) -> str:
    """Tables that go on over page ends become one, on the page where they begin.

    A chain goes on while the page whose table was taken holds no text of its own and no
    further table at its start.
    """
    before, pages, after = read_pages(text)
    for i, p in enumerate(pages):
        for q in pages[i + 1 :]:
            if not join_pages(p, q):
                break
            left = segments(q.body)
            if any(not s.table and not s.ignorable() for s in left) or _table_at(left, range(len(left))) is not None:
                break
    return with_end(write_pages(before, pages, after), text)


# What a row that is a section heading begins with; both widths of digits, brackets and stops are meant.
HEADING = re.compile(r"(?:[0-9０-９]+|[ivxlcdmIVXLCDM]+|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+)[.)．）]?|[(（][0-9０-９]+[)）]|[①-⑳]")
NUMBER = re.compile(r"[0-9０-９]+|[ivxlcdmIVXLCDM]+|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+")


def title(parts: list[str]) -> str:
    """Cells as one line; a number and a cell that begins with its bracket stand together."""
    if len(parts) > 1 and NUMBER.fullmatch(parts[0]) and parts[1].startswith((")", "）")):
        parts = [parts[0] + parts[1], *parts[2:]]
    return " ".join(parts)


def _outer(t: Segment) -> list[str]:
    if len(t.lines) <= 2:
        return t.lines
    full = [(i, [c for c in cells(r) if c]) for i, r in enumerate(t.rows)]
    full = [(i, c) for i, c in full if c]
    top = full[0] if full and HEADING.fullmatch(full[0][1][0]) else None
    note = next(((i, c) for i, c in reversed(full) if c[0].startswith(("※", "*"))), None)
    gone = {x[0] for x in (top, note) if x}
    rows = [r for i, r in enumerate(t.rows) if i not in gone]
    return [*([title(top[1])] if top else []), _counted(t.lines[0], rows), *rows, t.lines[-1], *([" ".join(note[1])] if note else [])]


def rows_outside(text: str) -> str:
    """A table's first row goes above it if it is a heading, its last note below it."""
    return with_end([x for s in segments(text.splitlines()) for x in (_outer(s) if s.table else s.lines)], text)


def post_clean_text(text: str) -> str:
    return rows_outside(join_tables(without_page_numbers(marks_on_lines(text))))


#: All four rules in order, in one pass over each document.
post_clean = per_text(post_clean_text)
