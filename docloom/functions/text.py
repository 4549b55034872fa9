"""Text operators as column expressions. Patterns are literals unless said otherwise.

White space and line ends are those of Unicode as the rule language defines them: 29
space characters and ten line ends, not just blanks and newlines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LB = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def quoted(literal: str) -> str:
    """A Java regex for exactly these characters."""
    return re.sub(r"([^\w\s]|\\)", r"\\\1", literal, flags=re.ASCII) if literal.isascii() else "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c if not c.isspace() else c for c in literal)


def strip_u(t: Column) -> Column:
    return F.regexp_replace(t, f"^{WS}+|{WS}+$", "")


def split_lines(t: Column) -> Column:
    """Lines without their ends; '' has none, a last line end adds none."""
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(t, f"(?:{LB})\\z", ""), LB, -1))


def remove_empty_lines(t: Column) -> Column:
    return F.array_join(F.filter(split_lines(t), lambda x: strip_u(x) != ""), "\n")


def slice_after(t: Column, literal: str, on_miss: str = "null") -> Column:
    """Text after the first occurrence. on_miss: null, keep or empty."""
    got = t if literal == "" else F.get(F.split(t, quoted(literal), 2), F.lit(1))
    return _missed(got, t, on_miss)


def slice_before(t: Column, literal: str, on_miss: str = "null") -> Column:
    """Text before the first occurrence."""
    if literal == "":
        return _missed(F.when(t.isNotNull(), F.lit("")), t, on_miss)
    parts = F.split(t, quoted(literal), 2)
    return _missed(F.when(F.size(parts) > 1, F.get(parts, F.lit(0))), t, on_miss)


def _missed(got: Column, t: Column, on_miss: str) -> Column:
    return {"null": got, "keep": F.coalesce(got, t), "empty": F.coalesce(got, F.when(t.isNotNull(), F.lit("")))}[on_miss]


def search_first(t: Column, literal: str) -> Column:
    """Offset from 0 of the first occurrence, null if none; the empty pattern is at 0."""
    return F.when(F.instr(t, literal) > 0, F.instr(t, literal) - 1) if literal else F.when(t.isNotNull(), F.lit(0))


def search_all(t: Column, literals: list[str]) -> Column:
    out = F.lit(True)
    for x in literals:
        out = out & F.contains(t, F.lit(x))
    return out


def search_any(t: Column, literals: list[str]) -> Column:
    """Struct (at, item) of the earliest occurrence; ties go to the item listed first."""
    hits = [F.when(F.instr(t, x) > 0, F.struct((F.instr(t, x) - 1).alias("at"), F.lit(i).alias("item"))) for i, x in enumerate(literals)]
    return F.array_min(F.array_compact(F.array(*hits)))


def search_ordered(t: Column, literals: list[str]) -> Column:
    """Struct (at, item) of the first listed item that occurs."""
    return F.coalesce(*[F.when(F.instr(t, x) > 0, F.struct((F.instr(t, x) - 1).alias("at"), F.lit(i).alias("item"))) for i, x in enumerate(literals)])


def search_first_n(t: Column, n: int, literal: str) -> Column:
    return F.contains(F.substring(t, 1, max(n, 0)), F.lit(literal))


def remove_tables(t: Column) -> Column:
    """Table blocks go; an unfinished one takes the rest along; stray ends go."""
    cut = F.regexp_replace(t, r"(?s)\[\[TABLE_START.*?(?:\[\[TABLE_END\]\]|\z)", "")
    return F.replace(cut, F.lit("[[TABLE_END]]"), F.lit(""))


# The marks that an edge may stand behind.
_SKIP = rf"(?:{WS}|\[\[(?:PAGE_START[^\]]*|PAGE_END|TABLE_START[^\]]*|TABLE_END|HEADING)\]\]|[\x{{200b}}-\x{{200d}}\x{{feff}}])*"


def replace_start(t: Column, old: str, new: str) -> Column:
    """At the start of the text, past white space, page markers and invisible characters, which stay."""
    past = F.regexp_replace(t, rf"\A({_SKIP}){_loose(old)}", "$1" + _dollar(new))
    return F.when(t.startswith(old), F.concat(F.lit(new), F.substring(t, len(old) + 1, F.length(t)))).otherwise(past)


def replace_end(t: Column, old: str, new: str) -> Column:
    past = F.regexp_replace(t, rf"{_loose(old)}({_SKIP})\z", _dollar(new) + "$1")
    return F.when(t.endswith(old), F.concat(F.substring(t, F.lit(1), F.length(t) - len(old)), F.lit(new))).otherwise(past)


def _loose(x: str) -> str:
    return r"[\x{200b}-\x{200d}\x{feff}]*".join(map(quoted, x))


def _dollar(x: str) -> str:
    return x.replace("\\", "\\\\").replace("$", "\\$")


def finalise(t: Column, keep_edges: bool = False) -> Column:
    """Page, bare table and heading markers go, then blank lines and outer space.

    With ``keep_edges`` lines end at newlines alone, blank ones hold nothing but blanks of any width, and all others stay as they are.
    """
    bare = F.regexp_replace(t, rf"\[\[PAGE_START{WS}*\d*{WS}*\]\]|\[\[PAGE_END\]\]|\[\[TABLE_START{WS}*\d*{WS}*\]\]|\[\[TABLE_END\]\]|\[\[HEADING\]\]{WS}*\d*", "")
    if keep_edges:
        return F.array_join(F.filter(F.split(bare, "\n", -1), lambda x: x.rlike(r"[^\p{Zs}]")), "\n")
    return strip_u(remove_empty_lines(bare))


def page_number(original: Column, value: Column) -> Column:
    """The number of the last page start at or before the value's first occurrence; null if none."""
    at = F.instr(original, value)
    before = F.when((at > 0) & (value != ""), F.substring(original, F.lit(1), at - 1))
    return F.try_element_at(F.regexp_extract_all(before, F.lit(r"\[\[PAGE_START\s*(\d+)\s*\]\]"), F.lit(1)), F.lit(-1)).cast("int")


def compact_spaces(t: Column, keep: bool = True) -> Column:
    return strip_u(F.regexp_replace(t, f"{WS}+", " ")) if keep else F.regexp_replace(t, f"{WS}+", "")


def compress_spaces(t: Column) -> Column:
    """Per line: runs of space become one blank, edges go, the last line end goes."""
    return F.array_join(F.transform(split_lines(t), lambda x: strip_u(F.regexp_replace(x, f"{WS}+", " "))), "\n")


# Units that lose the blanks around them.
UNITS = "年月日式件円m㎜％%"


def unit_spaces(t: Column) -> Column:
    return F.regexp_replace(t, f" (?=[{UNITS}])|(?<=[{UNITS}]) ", "")


# What becomes a hyphen.
DASHES = "－—─–―"


def dashes(t: Column) -> Column:
    return F.translate(t, DASHES, "-" * len(DASHES))


# Roman numeral characters and their spelling.
ROMAN = {"Ⅰ": "I", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "Ⅴ": "V", "Ⅵ": "VI", "Ⅶ": "VII", "Ⅷ": "VIII", "Ⅸ": "IX", "Ⅹ": "X", "Ⅺ": "XI", "Ⅻ": "XII", "Ⅼ": "L", "Ⅽ": "C", "Ⅾ": "D", "Ⅿ": "M"}


def roman_numerals(t: Column) -> Column:
    for k, v in ROMAN.items():
        t = F.replace(t, F.lit(k), F.lit(v))
    return t


def full_width(t: Column) -> Column:
    """ASCII to full width, blank to the ideographic space. Kana go through ``normalize.to_fullwidth``."""
    src = "".join(map(chr, range(0x20, 0x7F)))
    return F.translate(t, src, "　" + "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)))


#: What Unicode holds to be a digit, superscripts and circled ones among them.
DIGIT = "[" + "".join(f"\\x{{{i:x}}}" for i in range(0x110000) if chr(i).isdigit()) + "]"


# A page number in dashes, as a sheet or a page.
FOOTER = r"(?:-[- ]*{WS}*{DIGIT}+{WS}*[- ]*-|第{DIGIT}+頁|(?i:page )(?:(?i:page )|{WS})*{DIGIT}(?:{DIGIT}|(?i:page ))*)\Z"


def is_footer(line: Column) -> Column:
    """Short lines that hold only a page number, in dashes, as a sheet or a page."""
    x = strip_u(line)
    return (F.length(x) <= 12) & x.rlike("^" + FOOTER.replace("{WS}", WS).replace("{DIGIT}", DIGIT).replace(r"\Z", r"\z"))


def drop_footers(t: Column) -> Column:
    return F.array_join(F.filter(split_lines(t), lambda x: ~is_footer(x)), "\n")


def drop_page_digits(t: Column) -> Column:
    """Page numbers between dashes, form feeds and newlines go."""
    return F.regexp_replace(t, r"- \d{0,3} -|\x0c|\n", "")


def has_cjk(t: Column) -> Column:
    return t.rlike(r"[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{ff66}-\x{ff9d}々〆ヶ]")


def is_label(line: Column) -> Column:
    """Whether a list item is a short label for a value to come."""
    # What labels end with.
    core = F.regexp_replace(strip_u(line), rf"^(?:[0-9０-９IVXivx一二三四五六七八九十①-⑳()（）.]|{WS})+", "")
    return (F.length(core) > 0) & (F.length(core) <= 12) & core.rlike("(?:日|等|名|場所|内容|概要|期|期間|方法|方式|金額)$")


# Bad splits and what they are to be.
SPLIT_WORDS = (("入 札", "入札"), ("に ついて", "について"))


def common_split_words(t: Column) -> Column:
    """Two very common bad splits, mended in this order."""
    for bad, good in SPLIT_WORDS:
        t = F.replace(t, F.lit(bad), F.lit(good))
    return t


def table_meta(header: Column) -> Column:
    """key=value tokens of a table header as a map."""
    inner = F.regexp_extract(header, r"\[\[TABLE_START\s*([^\]]*)\]\]", 1)
    pairs = F.filter(F.split(F.trim(inner), " +"), lambda x: F.contains(x, F.lit("=")))
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1), F.substring(x, F.instr(x, F.lit("=")) + 1, F.length(x)))))


def split_cells(row: Column) -> Column:
    return F.transform(F.split(row, r"\|", -1), lambda c: strip_u(c))


def join_cells(cells: Column) -> Column:
    return F.array_join(cells, " | ")


def estimated_columns(rows: Column) -> Column:
    """Cells of the first row that has more than one; bars at its edges don't count. Null if there is none."""
    bare = F.transform(rows, lambda r: F.regexp_replace(strip_u(r), r"^\|+|\|+$", ""))
    return F.get(F.filter(F.transform(bare, lambda r: F.size(F.split(r, r"\|", -1))), lambda n: n > 1), F.lit(0))


def columns_compatible(a: Column, b: Column) -> Column:
    d, least = F.abs(a - b), F.least(a, b)
    return a.isNull() | b.isNull() | (d <= 2) | ((least > 0) & (4 * d <= least))


def sanitize_cell(t: Column) -> Column:
    """Cell text with single blanks; null is empty."""
    return compact_spaces(F.coalesce(t.cast("string"), F.lit("")))


def table_block(rows: Column, label: Column, n_rows: Column, n_cols: Column) -> Column:
    """A table as a text block. rows: array of arrays of cells."""
    body = F.array_join(F.transform(rows, lambda r: F.array_join(F.transform(r, sanitize_cell), " | ")), "\n")
    head = F.concat(F.lit("[[TABLE_START "), label, F.lit(" rows="), n_rows.cast("string"), F.lit(" cols="), n_cols.cast("string"), F.lit("]]\n"))
    return F.concat(head, F.when(body != "", F.concat(body, F.lit("\n"))).otherwise(F.lit("")), F.lit("[[TABLE_END]]\n\n"))


def occurrences(t: Column, pattern: str) -> Column:
    """Array of structs (start, end), from 0, of the matches of a regular expression without groups, left to right."""
    parts, found = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    sizes = F.zip_with(parts, found, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["size"], F.lit(0))
        more = F.when(x["size"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end")))))
        return F.struct(end.alias("at"), more.alias("out"))

    return F.aggregate(sizes, zero, step)["out"]


def ranked_matches(t: Column, literals: list[str]) -> Column:
    """Array of structs (at, item) of the items that occur, by the place of their first occurrence; ties in the order listed."""
    hits = [F.when(F.instr(t, x) > 0, F.struct((F.instr(t, x) - 1).alias("at"), F.lit(i).alias("item"))) for i, x in enumerate(literals)]
    return F.array_sort(F.array_compact(F.array(*hits)))


def has_word(t: Column, word: str) -> Column:
    """Whether a word stands in the text with no letter, digit or underscore at its sides."""
    return t.rlike(rf"(?<![\p{{L}}\p{{N}}_]){quoted(word)}(?![\p{{L}}\p{{N}}_])")
