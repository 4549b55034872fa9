"""Normalisers that need Unicode tables: Arrow functions over text columns."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column

from docloom.functions.folds import batches


def circled(n: int) -> str | None:
    if n == 0:
        return "⓪"
    for lo, hi, base in ((1, 20, 0x2460), (21, 35, 0x3251), (36, 50, 0x32B1)):
        if lo <= n <= hi:
            return chr(base + n - lo)
    return None


def circle_numbers(t: str) -> str:
    """((n)) in either width becomes a circled number for 0 to 50."""
    return re.sub(r"[(（]{2}([0-9０-９]{1,3})[)）]{2}", lambda m: circled(int(unicodedata.normalize("NFKC", m[1]))) or m[0], t)


def widen(t: str) -> str:
    t = re.sub(r"[｡-ﾟ]+", lambda m: unicodedata.normalize("NFKC", m[0]), t)
    return "".join("　" if c == " " else chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in t)


# Replaced after compatibility normalisation.
AFTER_NFKC = {"・": "･", "〜": "~"}


def narrow(t: str) -> str:
    """NFKC, but ① to ⑳ stay."""
    parts = re.split(r"([①-⑳])", t)
    return "".join(p if i % 2 else unicodedata.normalize("NFKC", p).translate(str.maketrans(AFTER_NFKC)) for i, p in enumerate(parts))


def to_fullwidth(t: Column) -> Column:
    return batches(widen)(t)


def to_halfwidth(t: Column) -> Column:
    return batches(narrow)(t)


def circle(t: Column) -> Column:
    return batches(circle_numbers)(t)


def output_value(name: str, t: Column) -> Column:
    """The project name is widened with circled numbers; every other string loses its blanks."""
    from pyspark.sql import functions as F

    return to_fullwidth(circle(t)) if name.strip("「」") == "工事名" else F.replace(t, F.lit(" "), F.lit(""))
