"""Rules of the cleaner that are off unless asked for."""

from __future__ import annotations

import re
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.cleaner import TITLE
from docloom.functions.folds import from_end, with_end
from docloom.functions.tables import Page, Segment, header, read_header, read_pages, segments, write_pages

# What the heads of pages begin with, what offices are called by, and the mark of a doubt.
PAGE_HEADS = ("国土交通省", "北海道開発局", "東北地方整備局", "関東地方整備局", "中部地方整備局", "近畿地方整備局", "中国地方整備局", "四国地方整備局", "九州地方整備局", "入札説明書", "工事請負契約書", "契約書様式")
OFFICES = "局省部課"
DOUBT = "[疑いフラグ] "


def without_page_heads(t: Column) -> Column:
    """Lines that begin like the head of a page go; short ones that name an office and are no sentence are marked as doubtful."""
    head = "|".join(map(T.quoted, PAGE_HEADS))
    kept = F.filter(T.split_lines(t), lambda x: ~T.strip_u(x).rlike(f"^(?:{head})"))

    def marked(x: Column) -> Column:
        bare = T.strip_u(x)
        return F.when((F.length(bare) <= 25) & bare.rlike(f"[{OFFICES}]") & ~bare.endswith("。"), F.concat(F.lit(DOUBT), x)).otherwise(x)

    return F.array_join(F.transform(kept, marked), "\n")


# Words that tell an announcement.
ANNOUNCED = ("入札公告", "一般競争入札公告", "公告日", "公告番号", "入札参加資格", "参加申請", "指名停止", "公告期間", "調達ポータル", "入札情報サービス")


def announcement(lines: list[str]) -> tuple[int, int, str] | None:
    """(first line, line after it, word) of an announcement.

    Before the title it reaches up to it. Without a title it ends at the second blank line
    or the second that looks like a heading, or after ten lines. Where the title stands
    first, the five lines from the word on count.
    """
    word = [next((k for k in ANNOUNCED if k in x), None) for x in lines]
    title = next((i for i, x in enumerate(lines) if TITLE in x), None)
    first = next((i for i in range(len(lines) if title is None else title) if word[i]), None)
    if first is None:
        later = next((i for i in range(title + 1, len(lines)) if word[i]), None) if title is not None else None
        return None if later is None else (later, min(later + 5, len(lines)), word[later])
    if title is not None:
        return first, title, word[first]
    blank = heads = 0
    for j in range(first + 1, len(lines)):
        x = lines[j].strip()
        blank += not x
        heads += x.endswith(("：", ":", "）"))
        if max(blank, heads) > 1:
            return first, j, word[first]
    return first, min(first + 10, len(lines)), word[first]


def without_announcement(text: str) -> str:
    lines = text.splitlines()
    if hit := announcement(lines):
        del lines[hit[0] : hit[1]]
    return "\n".join(lines)


def start_at_any_title(text: str) -> str:
    """Starts at the first line that begins with the title, blanks aside, or at the first that spells it one character a line; keeps the page start before it."""
    lines = text.splitlines()
    bare = ["".join(x.split()) for x in lines]
    for i, x in enumerate(bare):
        j = i
        while j < len(bare) and len(lines[j].strip()) == 1 and bare[j] in TITLE:
            j += 1
        end = i + 1 if x.startswith(TITLE) else j if "".join(bare[i:j]) == TITLE else 0
        if end:
            page = next((y.strip() for y in reversed(lines[:i]) if y.strip().startswith("[[PAGE_START ") and y.strip().endswith("]]")), None)
            return ("" if page is None else page + "\n") + TITLE + from_end(text, end)
    return text


# What headings of the three levels begin with.
LEVELS = (
    ("1.", "2.", "3.", "(1)", "(2)", "(3)", "I.", "II.", "III.", "A.", "B.", "C."),
    ("①", "②", "③", "a.", "b.", "c.", "(1)", "(2)", "(3)"),
    ("ア", "イ", "ウ", "(ア)", "(イ)", "(ウ)", "A)", "B)", "C)"),
)


def indented(text: str) -> str:
    """Headings are set in by two wide blanks for each level below the first; two empty lines come before one that is no deeper than the last."""
    out: list[str] = []
    last = 0
    for line in text.splitlines():
        x = line.strip()
        level = next((i for i, p in enumerate(LEVELS, 1) if x.startswith(p)), 0)
        if level:
            out += ["", ""] if level <= last else []
            out.append("　" * (2 * level - 2) + x)
            last = level
        else:
            out.append(line)
    return "\n".join(out)


# What begins a point here, and which edges join without a blank.
POINT = re.compile(r"[・＊*\-―○●◎◇◆□■▲△①-⑳]|\d ?[).．）]|[^\W\d_][).）]|[(（]\d")
TIGHT_BEFORE = "、。，．,.!?;:)]）｝」』】〉》〕］>％"
TIGHT_AFTER = "([（｛「『【〈《〔［{<"


def unwrapped(text: str) -> str:
    """The lines after a point join it, up to a blank line or the next point; its indent stays."""
    out: list[str] = []
    open_ = False
    for line in text.splitlines():
        x = line.strip()
        starts = POINT.match(x) is not None
        if open_ and x and not starts:
            out[-1] += ("" if out[-1][-1] in TIGHT_AFTER or x[0] in TIGHT_BEFORE else " ") + x
        else:
            out.append(line.rstrip() if starts else line if x else "")
            open_ = starts
    return with_end(out, text)


_NOTE = re.compile(r"\s*(?:※|注[）)])(.*)", re.S)


def _note(line: str) -> str:
    m, bare = _NOTE.match(line), line.lstrip()
    said = m[1].strip() if m else bare.removeprefix("【注】").strip() if bare.startswith("【注】") else bare
    return f"【注】 {said}" if said else "【注】"


def footnotes(text: str) -> str:
    """Footnotes stand alone between blank lines; those in tables, and rows that name CORINS, go to the end and from the table's count of rows."""
    out: list[str] = []
    last: list[str] = []

    def alone(note: str) -> None:
        if out and out[-1].strip():
            out.append("")
        out.extend([note, ""])

    for s in segments(text.splitlines()):
        if not s.table:
            for x in s.lines:
                if _NOTE.match(x):
                    alone(_note(x))
                else:
                    out.append(x)
            continue
        first, *rest = s.lines
        end = [rest.pop()] if rest and rest[-1].startswith("[[TABLE_END") else []
        notes = [x for x in rest if _NOTE.match(x) or "corins" in x.lower()]
        meta = read_header(first)
        if notes and isinstance(meta.get("rows"), int):
            first = header({**meta, "rows": max(0, meta["rows"] - len(notes))})
        out += [first, *(x for x in rest if x not in notes), *end]
        last += map(_note, notes)
    if last:
        alone(last[0])
        for x in last[1:]:
            out.extend([x, ""])
    whole = "\n".join(out)
    return whole + "\n" if text.endswith("\n") and not whole.endswith("\n") else whole


def _only_table(parts: list[Segment], order: range) -> int | None:
    i = next((i for i in order if parts[i].table or any(x.strip() for x in parts[i].lines)), None)
    return i if i is not None and parts[i].table else None


def _join_strictly(a: Page, b: Page) -> bool:
    pa, pb = segments(a.body), segments(b.body)
    i, j = _only_table(pa, range(len(pa) - 1, -1, -1)), _only_table(pb, range(len(pb)))
    if i is None or j is None:
        return False
    x, y = pa[i], pb[j]
    mx, my = read_header(x.lines[0]), read_header(y.lines[0])
    if not mx or not my or mx.get("cols") != my.get("cols"):
        return False
    rows = sum(m["rows"] if isinstance(m.get("rows"), int) else len(t.rows) for m, t in ((mx, x), (my, y)))
    first = header({k: {**mx, "rows": rows}.get(k, "") for k in ("page", "index", "rows", "cols")})
    x.lines = [first, *x.lines[1:-1], *y.rows, x.lines[-1]]
    del pb[j]
    a.body, b.body = ([x for s in parts for x in s.lines] for parts in (pa, pb))
    return True


def join_tables_strictly(text: str) -> str:
    """Tables of as many columns with nothing but blank lines between them become one, from the last page back, so chains end where they begin."""
    before, pages, after = read_pages(text)
    for i in range(len(pages) - 2, -1, -1):
        for _ in count():
            if not _join_strictly(pages[i], pages[i + 1]):
                break
    return with_end(write_pages(before, pages, after), text)
