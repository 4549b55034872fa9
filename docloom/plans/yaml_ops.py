"""The second rule language: a list of operations, each a mapping with ``op`` and its arguments.

``emit_rows`` turns a program into columns: the text, the buffers and the variables of
a document are columns, and each operation changes them under the conditions of the
branches it stands in. ``run_steps`` says the same for one document in Python; tests
hold the two against each other. Unknown operations are passed over.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.text import quoted


class State:
    """One document while its steps run: text, buffers, variables and rows emitted."""

    def __init__(self, name: str, text: str) -> None:
        self.name, self.whole, self.text = name, text, text
        self.buffers: dict[str, str] = {}
        self.vars: dict[str, object] = {}
        self.rows: list[tuple[str, str]] = []

    def change(self, var: str | None, f) -> None:
        """Of the text, or of a variable that holds a string."""
        if not var:
            self.text = f(self.text)
        elif isinstance(self.vars.get(var), str):
            self.vars[var] = f(self.vars[var])

    def said(self, a: dict, otherwise: object) -> object:
        return self.vars[a["from_var"]] if a.get("from_var") in self.vars else otherwise


def _squeeze(a: dict):
    return (lambda v: re.sub(r"\s+", " ", v).strip()) if a.get("keep_spaces") else (lambda v: re.sub(r"\s+", "", v))


def holds(value: object, a: dict) -> bool:
    """The first test that an ``if_var`` has decides; without one it is false."""
    if "equals" in a:
        return value == a["equals"]
    if "not_equals" in a:
        return value != a["not_equals"]
    return bool(value) if a.get("truthy") else bool(a.get("falsy")) and not value


def run_steps(s: State, steps: list[dict]) -> None:
    for a in steps:
        op = a.get("op")
        if op == "contains" and a.get("set"):
            n = int(a.get("n", 0))
            s.vars[a["set"]] = a.get("phrase", "") in (s.text[:n] if a.get("in") == "first_n" and n > 0 else s.text)
        elif op in ("find_after", "take_before") and (p := a.get("pattern", "")) and p in s.text:
            got = s.text.partition(p)[2 if op == "find_after" else 0]
            if a.get("into"):
                s.vars[a["into"]] = got
            else:
                s.text = got
        elif op == "copy" and a.get("as"):
            s.buffers[a["as"]] = s.text
        elif op == "restore":
            s.text = s.buffers.get(a.get("from", ""), s.text)
        elif op == "set_text":
            s.text = str(s.said(a, a.get("literal", s.text)))
        elif op == "set_var" and a.get("name"):
            s.vars[a["name"]] = s.text if a.get("from_text") else a.get("literal")
        elif op == "strip":
            s.change(a.get("var"), str.strip)
        elif op == "compact_ws":
            s.change(a.get("var"), _squeeze(a))
        elif op == "concat" and a.get("target"):
            own = s.text if a.get("from_text") else s.said(a, "")
            s.vars[a["target"]] = f"{a.get('prefix', '')}{own}{a.get('suffix', '')}"
        elif op == "emit":
            s.rows.append((a.get("key", "output"), str(s.said(a, a.get("literal", "")))))
        elif op == "if_var":
            run_steps(s, a.get("then" if holds(s.vars.get(a.get("var", "")), a) else "else") or [])


def _kind(v: object) -> str:
    return "none" if v is None else "bool" if isinstance(v, bool) else "str" if isinstance(v, str) else "num"


def _value(v: object) -> Column:
    return F.struct(F.lit(_kind(v)).alias("kind"), F.lit(str(v)).alias("s"))


def _string(c: Column) -> Column:
    return F.struct(F.lit("str").alias("kind"), c.alias("s"))


class Columns:
    """The same state for all documents: ``_t`` the text, ``_b*`` buffers, ``_v*`` variables (kind, s), null while unset."""

    def __init__(self, df: DataFrame) -> None:
        self.df, self.names, self.rows, self.n = df, {}, [], 0

    def at(self, kind: str, name: str) -> str:
        key = (kind, name)
        if key not in self.names:
            self.names[key] = f"_{kind}{len(self.names)}"
            self.df = self.df.withColumn(self.names[key], F.lit(None).cast("string" if kind == "b" else "struct<kind:string,s:string>"))
        return self.names[key]

    def put(self, name: str, value: Column, guard: str | None) -> None:
        self.df = self.df.withColumn(name, F.when(F.col(guard), value).otherwise(F.col(name)) if guard else value)

    def fresh(self, value: Column) -> str:
        self.n += 1
        self.df = self.df.withColumn(f"_g{self.n}", value)
        return f"_g{self.n}"

    def said(self, a: dict, otherwise: Column) -> Column:
        return F.coalesce(F.col(self.at("v", a["from_var"]))["s"], otherwise) if a.get("from_var") else otherwise

    def change(self, var: str | None, f, guard: str | None) -> None:
        if not var:
            self.put("_t", f(F.col("_t")), guard)
        else:
            v = F.col(name := self.at("v", var))
            self.put(name, F.when(v["kind"] == "str", _string(f(v["s"]))).otherwise(v), guard)

    def test(self, a: dict) -> Column:
        v = F.col(self.at("v", a.get("var", "")))
        kind, s = F.coalesce(v["kind"], F.lit("none")), v["s"]
        for key in ("equals", "not_equals"):
            if key in a:
                same = (kind == _kind(a[key])) & (F.lit(True) if a[key] is None else F.coalesce(s == str(a[key]), F.lit(False)))
                return same if key == "equals" else ~same
        true = F.when(kind == "bool", s == "True").when(kind == "str", s != "").when(kind == "num", s.cast("double") != 0).otherwise(F.lit(False))
        return true if a.get("truthy") else ~true if a.get("falsy") else F.lit(False)

    def run(self, steps: list[dict], guard: str | None = None) -> None:
        for a in steps:
            op, t = a.get("op"), F.col("_t")
            if op == "contains" and a.get("set"):
                n = int(a.get("n", 0))
                part = F.substring(t, 1, n) if a.get("in") == "first_n" and n > 0 else t
                found = F.contains(part, F.lit(a.get("phrase", "")))
                self.put(self.at("v", a["set"]), F.struct(F.lit("bool").alias("kind"), F.when(found, "True").otherwise("False").alias("s")), guard)
            elif op in ("find_after", "take_before") and a.get("pattern"):
                parts = F.split(t, quoted(a["pattern"]), 2)
                got = F.get(parts, F.lit(1 if op == "find_after" else 0))
                if a.get("into"):
                    name = self.at("v", a["into"])
                    self.put(name, F.when(F.size(parts) > 1, _string(got)).otherwise(F.col(name)), guard)
                else:
                    self.put("_t", F.coalesce(got, t) if op == "find_after" else got, guard)
            elif op == "copy" and a.get("as"):
                self.put(self.at("b", a["as"]), t, guard)
            elif op == "restore" and a.get("from"):
                self.put("_t", F.coalesce(F.col(self.at("b", a["from"])), t), guard)
            elif op == "set_text":
                self.put("_t", self.said(a, F.lit(str(a["literal"])) if "literal" in a else t), guard)
            elif op == "set_var" and a.get("name"):
                self.put(self.at("v", a["name"]), _string(t) if a.get("from_text") else _value(a.get("literal")), guard)
            elif op == "strip":
                self.change(a.get("var"), T.strip_u, guard)
            elif op == "compact_ws":
                self.change(a.get("var"), lambda c, keep=bool(a.get("keep_spaces")): T.compact_spaces(c, keep), guard)
            elif op == "concat" and a.get("target"):
                own = t if a.get("from_text") else self.said(a, F.lit(""))
                self.put(self.at("v", a["target"]), _string(F.concat(F.lit(str(a.get("prefix", ""))), own, F.lit(str(a.get("suffix", ""))))), guard)
            elif op == "emit":
                value = self.said(a, F.lit(str(a.get("literal", ""))))
                row = F.struct(F.lit(a.get("key", "output")).alias("key"), value.alias("value"))
                self.rows.append(self.fresh(F.when(F.col(guard), row) if guard else row))
            elif op == "if_var":
                ok = self.test(a)
                yes = self.fresh(F.col(guard) & ok if guard else ok)
                no = self.fresh(F.col(guard) & ~ok if guard else ~ok)
                self.run(a.get("then") or [], yes)
                self.run(a.get("else") or [], no)


def emit_rows(df: DataFrame, steps: list[dict], id_col: str, text: str = "text") -> DataFrame:
    """(id, seq, key, value): the rows each document emits, in order. A null text is empty."""
    c = Columns(df.select(id_col, F.coalesce(text, F.lit("")).alias("_t")))
    c.run(steps)
    rows = F.array_compact(F.array(*map(F.col, c.rows))) if c.rows else F.array().cast("array<struct<key:string,value:string>>")
    return c.df.select(id_col, F.posexplode(rows).alias("seq", "row")).select(id_col, "seq", "row.key", "row.value")
