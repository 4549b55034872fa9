"""Quality rules: learned decision lists over document statistics.

``statistics`` measures every whole text; ``learn_rules`` grows and prunes
threshold conjunctions by sequential covering on labelled statistics;
``rule_column`` emits them as one ordered Spark conditional expression.

Defined results for odd input: a null or empty text has no words, so it fails the
base rule; a null label is ignored; without labels there are no rules and only the
base rule decides; repeated rows are judged alike; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from docloom.llm.common import fresh, small_batches

WINDOW = 8
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("mean_word", "symbols", "dup_lines", "repeats", "upper", "digits", "exclaims", "pipes", "distinct", "same_as_last", "letters")
STATS = pa.struct([(c, pa.int64()) for c in COUNTS] + [(c, pa.float64()) for c in FEATURES])
STATS_DDL = "struct<" + ",".join([f"{c}:bigint" for c in COUNTS] + [f"{c}:double" for c in FEATURES]) + ">"

_CLASS: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Per code point: 1 lower letter, 2 upper letter, 3 digit, 4 other letter, 0 the rest."""
    if not _CLASS:
        c = np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            x = chr(i)
            if not x.isalnum():
                continue
            c[i] = 1 if x.islower() else 2 if x.isupper() else 3 if x.isdigit() else 4 if x.isalpha() else 0
        _CLASS.append(c)
    return _CLASS[0]


def repeated_words(ids: np.ndarray, k: int = WINDOW) -> int:
    """Words lying in a window of ``k`` words whose sequence occurs twice or more. Exact: ranks, not hashes."""
    n = len(ids)
    if n <= k:
        return 0
    rank, have = ids.astype(np.int64), 1
    while have < k:
        step = min(have, k - have)
        m = n - have - step + 1
        pair = rank[:m] * (n + 1) + rank[step : step + m]
        _, rank = np.unique(pair, return_inverse=True)
        have += step
    hit = np.flatnonzero(np.bincount(rank)[rank] > 1)
    if not len(hit):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + k, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def measure(text: str | None) -> tuple:
    """The statistics of one text, in the order COUNTS + FEATURES."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0) + (0.0,) * len(FEATURES)
    first: dict[bytes, int] = {}
    ids = np.array([first.setdefault(w, len(first)) for w in words], np.int64)
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    dup = len(lines) - len(set(lines))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(_classes()[codes], minlength=5)
    spaces = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    chars = len(codes) - spaces
    symbols = sum(map(text.count, SYMBOLS))
    rep = repeated_words(ids)
    letters = max(1, kinds[1] + kinds[2] + kinds[4])
    return (
        n, chars, symbols, dup, rep,
        chars / n, symbols / n, dup / max(1, len(lines)), rep / n, kinds[2] / letters, kinds[3] / chars, text.count("!") / n,
        text.count("|") / n, len(first) / n, float((ids[1:] == ids[:-1]).sum()) / n, (kinds[1] + kinds[2] + kinds[4]) / chars,
    )


def _measured(text: pa.Array) -> pa.Array:
    rows = [measure(t) for t in text.to_pylist()]
    cols = list(zip(*rows)) if rows else [[] for _ in STATS]
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, STATS)], fields=list(STATS))


def statistics(text: str | Column) -> Column:
    """A struct of the counts and features of a text column."""
    return arrow_udf(_measured, STATS_DDL).asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def base_failed(s: str) -> Column:
    n = F.col(f"{s}.n_words")
    return (n < 20) | (100 * F.col(f"{s}.n_repeat_words") > 30 * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    value: float

    def column(self, s: str) -> Column:
        c = F.col(f"{s}.{self.feature}")
        return c > F.lit(self.value) if self.above else c <= F.lit(self.value)

    def mask(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        v = x[:, names.index(self.feature)]
        return v > self.value if self.above else v <= self.value


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    m = np.ones(len(x), bool)
    for c in rule:
        m &= c.mask(x, names)
    return m


def _grow(x: np.ndarray, y: np.ndarray, names: tuple[str, ...], most: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(y), bool)
    while len(rule) < most:
        p0, n0 = int((inside & y).sum()), int((inside & ~y).sum())
        if not p0 or not n0:
            break
        before, best, pick = np.log2(p0 / (p0 + n0)), 1e-9, None
        for k, name in enumerate(names):
            v = x[inside, k]
            order = np.argsort(v, kind="stable")
            v, t = v[order], y[inside][order]
            ends = np.flatnonzero(v[1:] > v[:-1])
            if not len(ends):
                continue
            pos = np.cumsum(t)[ends]
            size = ends + 1
            for above, p, m in ((False, pos, size), (True, p0 - pos, len(v) - size)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / m) - before), 0)
                i = int(np.argmax(gain))
                if gain[i] > best:
                    best, pick = gain[i], Condition(name, above, float((v[ends[i]] + v[ends[i] + 1]) / 2))
        if pick is None:
            break
        rule.append(pick)
        inside &= pick.mask(x, names)
    return tuple(rule)


def learn_rules(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...] = FEATURES, max_rules: int = 16, max_conditions: int = 4, min_precision: float = 0.95, min_cover: int = 3) -> list[Rule]:
    """Sequential covering for the class ``bad``.

    Each rule grows on two thirds of what is left by information gain, is pruned to
    its best prefix on the other third, and is kept while its precision there
    reaches ``min_precision``; what it covers is then set aside.
    """
    rules: list[Rule] = []
    bad = bad.astype(bool)
    rng = np.random.default_rng(7)
    misses = 0
    while len(rules) < max_rules and bad.sum() >= min_cover and misses < 3:
        side = rng.permutation(len(bad)) % 3 == 0
        rule = _grow(x[~side], bad[~side], names, max_conditions)
        best, kept = -2.0, ()
        for k in range(1, len(rule) + 1):
            m = _covers(rule[:k], x[side], names)
            p, n = int((m & bad[side]).sum()), int((m & ~bad[side]).sum())
            if p + n and (p - n) / (p + n) > best:
                best, kept = (p - n) / (p + n), rule[:k]
        m = _covers(kept, x, names) if kept else np.zeros(len(bad), bool)
        p, n = int((m & bad).sum()), int((m & ~bad).sum())
        if not kept or p < min_cover or p < min_precision * (p + n) or (best + 1) / 2 < min_precision:
            misses += 1
            continue
        misses = 0
        rules.append(kept)
        x, bad = x[~m], bad[~m]
    return rules


def rule_column(rules: list[Rule], s: str) -> Column:
    """The number (from 1) of the first rule that holds, null where none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        cond = F.lit(True)
        for c in rule:
            cond = cond & c.column(s)
        out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8000) -> list[Rule]:
    """Learn from at most ``max_rows`` labelled documents, those with the smallest hashed ids."""
    small_batches(docs.sparkSession)
    sample = (
        labels.select(F.col("doc_id"), F.col("quality")).where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded by max_rows
        .select("doc_id", "quality", statistics("text").alias("s"))
        .select("doc_id", (F.col("quality") == 0).alias("bad"), *[f"s.{c}" for c in FEATURES])
    )
    pdf = rows.toPandas().sort_values(["doc_id", "bad"])
    if pdf.empty:
        return []
    return learn_rules(pdf[list(FEATURES)].to_numpy(float), pdf["bad"].to_numpy(bool))


def judge(docs: DataFrame, rules: list[Rule], s: str = "_quality") -> DataFrame:
    """``docs`` with a struct column ``s`` (statistics, base_failed, rule, kept) added."""
    small_batches(docs.sparkSession)
    s = fresh(s, docs.columns)
    measured = docs.withColumn(s, statistics("text"))
    failed = base_failed(s)
    rule = rule_column(rules, s)
    return measured.withColumn(s, F.struct(f"{s}.*", failed.alias("base_failed"), rule.alias("rule"), (~failed & rule.isNull()).alias("kept")))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed, kept and the number of the rule that rejected the text."""
    d = docs.select("doc_id", "text")
    out = judge(d, fit(d, labels), "q")
    return out.select("doc_id", *[f"q.{c}" for c in COUNTS], "q.base_failed", "q.kept", "q.rule")
