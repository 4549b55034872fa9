"""Rule programs as column expressions: what ``rules`` does for one document, for all at once and without Python workers.

What a step sees is kept in columns: the text taken so far, the last search, stored
texts and results. A step changes them under the condition of the blocks it stands in.
Each step is a projection of its own, so expressions don't grow with the program.
Numbers of pages are read in ASCII digits.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.plans import rules
from docloom.plans.rules import Node

_VALUE = "struct<kind:string,s:string>"
def _page(number: str) -> str:
    return rf"\[\[PAGE_START{T.WS}*{number}{T.WS}*\]\]"


def _string(c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(F.lit("str").alias("kind"), c.alias("s")))


def _plain(v: bool | str) -> Column:
    return F.struct(F.lit("bool" if isinstance(v, bool) else "str").alias("kind"), F.lit(str(v)).alias("s"))


class _Frame:
    """Names of the columns of a block that has a text of its own, and what may be pending there: scopes set and variables checked."""

    def __init__(self, p: Program, text: Column, guard: str | None) -> None:
        self.guard = guard
        self.text = p.new(text)
        self.found = p.new(F.lit(False))
        self.at, self.size, self.scope = (p.new(F.lit(None).cast("int")) for _ in range(3))
        self.searched, self.check, self.expected = (p.new(F.lit(None).cast("string")) for _ in range(3))
        self.result = p.new(F.lit(None).cast(_VALUE))
        self.scopes: list[tuple[str | None, int, Callable[[], Column]]] = []
        self.checked: set[str] = set()


class Program:
    def __init__(self, df: DataFrame) -> None:
        self.df, self.n = df, 0
        self.outputs: dict[str, str] = {}
        self.stored: dict[str, str] = {}

    def new(self, value: Column) -> str:
        self.n += 1
        self.df = self.df.withColumn(f"_r{self.n}", value)
        return f"_r{self.n}"

    def put(self, guard: str | None, **values: Column) -> None:
        self.df = self.df.withColumns({k: F.when(F.col(guard), v).otherwise(F.col(k)) if guard else v for k, v in values.items()})

    def lookup(self, name: str, otherwise: Column) -> Column:
        """A stored text, an output (which may be none), or else."""
        out = F.col(self.outputs[name]) if name in self.outputs else otherwise
        return F.when(F.col(self.stored[name]).isNotNull(), _string(F.col(self.stored[name]))).otherwise(out) if name in self.stored else out

    def scope(self, value: str, first: bool, f: _Frame) -> Callable[[], Column] | None:
        if first:
            n = int(value) if re.fullmatch(r"[+-]?\d+", value) else 0
            return lambda: F.substring("_o", 1, max(n, 0))
        if value.lower() in ("", "all"):
            return None
        if value.lower() == "taken":
            return lambda: F.col(f.text)

        def named() -> Column:
            out = F.lit(None).cast("string")
            if value in self.outputs:
                o = F.col(self.outputs[value])
                out = F.when(o["kind"] == "str", o["s"])
            return F.coalesce(*([F.col(self.stored[value])] if value in self.stored else []), out, F.col("_o"))

        return named

    def search(self, value: str, f: _Frame, guard: str | None) -> None:
        mode, items = rules.search_items(value)
        where = F.col("_o")
        for _, code, text in f.scopes:
            where = F.when(F.col(f.scope) == code, text()).otherwise(where)
        self.put(guard, **{f.searched: where})
        self.put(guard, **{f.scope: F.lit(None).cast("int")})
        f.scopes = [] if guard == f.guard else [x for x in f.scopes if x[0] != guard]
        s, none = F.col(f.searched), F.lit(None).cast("int")
        if mode == "all" or not items:
            self.put(guard, **{f.found: T.search_all(s, items) if mode == "all" else F.lit(False), f.at: none, f.size: none})
            return
        hit = self.new(T.search_ordered(s, items) if mode == "ordered" else T.search_any(s, items))
        sizes = F.array(*[F.lit(len(x)) for x in items])
        h = F.col(hit)
        self.put(guard, **{f.found: h.isNotNull(), f.at: h["at"], f.size: F.when(h.isNotNull(), F.get(sizes, F.coalesce(h["item"], F.lit(0))))})

    def holds(self, f: _Frame) -> Column:
        value = F.lit(None).cast(_VALUE)
        for name in sorted(f.checked):
            got = [F.col(self.outputs[name])] if name in self.outputs else []
            got += [_string(F.col(self.stored[name]))] if name in self.stored else []
            if got:
                value = F.when(F.col(f.check) == name, F.coalesce(*got)).otherwise(value)
        kind, s = value["kind"], value["s"]
        true = F.when(kind == "bool", s == "True").when(kind == "str", s != "")
        same = (kind == "str") & (s == F.col(f.expected))
        return F.coalesce(F.when(F.col(f.expected).isNotNull(), same).otherwise(true), F.lit(False))

    def simple(self, n: Node, f: _Frame, guard: str | None) -> None:
        name, value, call, t = n.name.strip().lower(), (n.value or "").strip(), n.kind == "command", F.col(f.text)
        if not call and name in ("search in", "search in first"):
            scope = self.scope(value, name.endswith("first"), f)
            f.scopes = [x for x in f.scopes if x[0] != guard]
            code = F.lit(None).cast("int")
            if scope:
                code = F.lit(self.n + 1)
                f.scopes.append((guard, self.n + 1, scope))
                self.n += 1
            self.put(guard, **{f.scope: code})
        elif not call and name == "search text":
            self.search(value, f, guard)
        elif not call and name == "check":
            f.checked.add(value)
            self.put(guard, **{f.check: F.lit(value)})
        elif not call and name == "has value":
            self.put(guard, **{f.expected: F.lit(rules.unquote(value))})
        elif name == "remove whitespaces":
            self.put(guard, **{f.text: T.strip_u(t)})
        elif name == "remove tables":
            self.put(guard, **{f.text: T.remove_tables(t)})
        elif name in ("add in right", "add in left"):
            literal = rules.add_escapes(rules.unquote(value))
            got = self.lookup(value, _plain(literal)) if rules.unquote(value) == value else _plain(literal)
            x = F.coalesce(got["s"], F.lit("None"))
            self.put(guard, **{f.text: F.concat(t, x) if name.endswith("right") else F.concat(x, t)})
        elif name == "store":
            if value not in self.stored:
                self.stored[value] = self.new(F.lit(None).cast("string"))
            self.put(guard, **{self.stored[value]: t})
        elif name == "set":
            if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
                got = _plain(value[1:-1])
            elif call and value.lower() == "all":
                got = _string(F.col("_o"))
            else:
                got = self.lookup(value, _plain({"true": True, "false": False}.get(value.lower(), value)))
            self.put(guard, **{f.result: got})
        elif name == "replace" and call:
            three = rules.split_args(n.value or "", 3)
            where = three[0].strip().lower()
            if len(three) == 3 and where in ("start", "end"):
                edge = T.replace_start if where == "start" else T.replace_end
                new = edge(t, three[1], three[2]) if three[1] else t
            else:
                old, to = (rules.split_args(n.value or "", 2) + [""])[:2]
                new = F.replace(t, F.lit(old), F.lit(to)) if old else F.regexp_replace(t, "", T._dollar(to))
            self.put(guard, **{f.text: new})

    def run(self, nodes: list[Node], f: _Frame, guard: str | None) -> None:
        for n in nodes:
            name = n.name.strip().lower()
            if n.kind in ("kv", "command"):
                self.simple(n, f, guard)
            elif name in ("take right", "take left"):
                s, at = F.col(f.searched), F.col(f.at)
                part = F.substring(s, at + F.col(f.size) + 1, F.length(s)) if name.endswith("right") else F.substring(s, F.lit(1), at)
                child = _Frame(self, F.when(at.isNotNull(), part).otherwise(F.col(f.text)), guard)
                self.run(n.children, child, guard)
                self.put(guard, **{f.result: F.coalesce(F.col(child.result), F.col(f.result))})
            else:
                test = {"if found": lambda: F.col(f.found), "if not found": lambda: ~F.col(f.found), "if true": lambda: self.holds(f), "if false": lambda: ~self.holds(f)}.get(name)
                inner = self.new(F.col(guard) & test() if guard else test()) if test else guard
                self.run(n.children, f, inner)


def extract(df: DataFrame, script: str, text: str = "text") -> DataFrame:
    """The other columns, a string column per variable and an integer one for its page, as ``rules.extract`` gives them."""
    keep = [c for c in df.columns if c != text]
    d = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_o"))
    d = d.withColumns({"_starts": F.transform(T.occurrences(F.col("_o"), _page(r"\d+")), lambda x: x["start"]), "_numbers": F.regexp_extract_all("_o", F.lit(_page(r"(\d+)")), F.lit(1))})
    p = Program(d)
    for n in rules.parse(script):
        if n.kind == "var":
            p.stored = {}
            f = _Frame(p, F.col("_o"), None)
            p.run(n.children, f, None)
            r = F.col(f.result)
            p.outputs[n.name] = p.new(F.when(r["kind"] == "str", _string(T.finalise(r["s"]))).otherwise(r))
    out = []
    for name, c in p.outputs.items():
        v = F.col(c)
        at = F.when((v["kind"] == "str") & (v["s"] != "") & (F.instr("_o", v["s"]) > 0), F.instr("_o", v["s"]) - 1)
        before = F.when(at.isNotNull(), F.size(F.filter("_starts", lambda s, at=at: s <= at)))
        out += [v["s"].alias(name), F.when(before > 0, F.get("_numbers", before - 1)).cast("int").alias(f"{name} pageNo")]
    return p.df.select(*[F.col(f"`{c}`") for c in keep], *out)
