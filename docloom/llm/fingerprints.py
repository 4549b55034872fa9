"""Document fingerprints: a Merkle tree of pieces, paragraphs, sections and root.

DataFrame functions only. A paragraph is a line of the text; its leaves are runs of
``leaf`` code points; its node hashes its leaves' hashes. A section is a run of
paragraphs that ends after one whose hash starts with 0-3 (content-defined, so an
edit moves no later boundary) ; the root hashes the sections. Equal texts have equal
roots; comparing two trees level by level finds the branches that differ, and the nodes
that two lists share at either end tell where an edit lies.

Defined results: a null text is an empty text, one empty paragraph; equal rows get
equal rows; ids that are null come last in descending order.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = 64


def tree(text: Column, leaf: int = LEAF) -> Column:
    """An array with one struct (hash, leaves: array of hashes) per paragraph."""
    def node(line: Column) -> Column:
        leaves = F.transform(F.regexp_extract_all(line, F.lit(f"(?s).{{1,{leaf}}}"), F.lit(0)), lambda x: F.md5(x))
        return leaves

    return F.transform(F.split(text, "\n", -1), node)


def paragraph_hashes(leaves: Column) -> Column:
    return F.transform(leaves, lambda x: F.md5(F.array_join(x, "")))


def section_hashes(paragraphs: Column) -> Column:
    """Join the hashes, break after the paragraphs that end a section, hash each run."""
    text = F.array_join(F.transform(paragraphs, lambda h: F.concat(h, F.when(h < "4", F.lit("/")).otherwise(F.lit("")))), "")
    return F.transform(F.split(F.regexp_replace(text, "/$", ""), "/"), lambda x: F.md5(x))


def root_hash(sections: Column) -> Column:
    return F.sha2(F.array_join(sections, ""), 256)


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: struct(root, sections, paragraphs, leaves)."""
    df = df.withColumn(f"{name}_l", tree(F.col(text)))
    df = df.withColumn(f"{name}_p", paragraph_hashes(F.col(f"{name}_l")))
    df = df.withColumn(f"{name}_s", section_hashes(F.col(f"{name}_p")))
    whole = F.struct(root_hash(F.col(f"{name}_s")).alias("root"), F.col(f"{name}_s").alias("sections"), F.col(f"{name}_p").alias("paragraphs"), F.array_distinct(F.flatten(f"{name}_l")).alias("leaves"))
    return df.withColumn(name, whole).drop(f"{name}_l", f"{name}_p", f"{name}_s")


def likeness(a: Column, b: Column) -> Column:
    """Of two trees, 0 to 1: shared leaves, twice, over all leaves; 1 for equal roots."""
    shared = F.size(F.array_intersect(a["leaves"], b["leaves"]))
    total = F.size(a["leaves"]) + F.size(b["leaves"])
    return F.when(a["root"] == b["root"], F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(2.0 * shared / total)


def differing(a: Column, b: Column, level: str) -> Column:
    """The distinct nodes of ``a`` at ``level`` that ``b`` has not, in time linear in both."""
    return F.array_except(a[level], b[level])


def same_at_start(a: Column, b: Column) -> Column:
    """How many nodes two lists of hashes have in common before the first that differs."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(a)).cast("long")


def changed(a: Column, b: Column, level: str) -> tuple[Column, Column]:
    """Where an edit lies at ``level``: the nodes before it and the nodes after it that both trees have in common."""
    return same_at_start(a[level], b[level]), same_at_start(F.reverse(a[level]), F.reverse(b[level]))


def below(value: Column, cuts: list) -> Column:
    """How many of the ascending cuts lie below a value, sought in two steps of about the root of their number each."""
    if not cuts:
        return F.lit(0)
    k = ceil(len(cuts) ** 0.5)
    runs = [cuts[i : i + k] for i in range(0, len(cuts), k)]

    def count(of: Column) -> Column:
        return F.size(F.filter(of, lambda c: c < value))

    run = count(F.array(*[F.lit(r[0]) for r in runs]))
    inside = F.get(F.array(*[F.array(*map(F.lit, r)) for r in runs]), run - 1)
    return F.when(run == 0, F.lit(0)).otherwise((run - 1) * k + count(inside))


def edited_pairs(docs: DataFrame, most_broadcast: int = 64 << 20) -> DataFrame:
    """doc_id, text, its next document's text and the edited text.

    Texts are dealt once, to ranges of ids cut at quantiles, so that nearly every next
    document is in the same task; only the last text of each range is sent to the range
    above (broadcast if all of them take less than ``most_broadcast`` code points).
    Rows that repeat an id follow one another.
    """
    spark = docs.sparkSession
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    got = d.agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / n) for i in range(1, n)]), 10000).alias("c")).first()["c"] or []
    cuts = sorted(set(got))
    part = below(F.col("doc_id"), cuts)
    dealt = d.select("doc_id", "text", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(part).alias("_b"), F.xxhash64("text").alias("_h"))
    inside = dealt.withColumn("_n", F.lag("text").over(Window.partitionBy("_b").orderBy(F.asc_nulls_first("doc_id"), "_h")))
    tops = sorted(dealt.groupBy("_b").agg(F.max(F.struct("doc_id", "_h")).alias("t")).collect(), key=lambda r: r["_b"])  # a row per range
    to = [(r["_b"], r["t"]["doc_id"], r["t"]["_h"], tops[(i + 1) % len(tops)]["_b"]) for i, r in enumerate(tops)]
    ends = spark.createDataFrame(to, f"_tb int, _td {docs.schema['doc_id'].dataType.simpleString()}, _th long, _to int")
    last = dealt.join(F.broadcast(ends), (F.col("_b") == F.col("_tb")) & F.col("doc_id").eqNullSafe(F.col("_td")) & (F.col("_h") == F.col("_th")))
    last = last.groupBy("_to").agg(F.min("text").alias("_e"))
    size = last.agg(F.sum(F.length("_e"))).first()[0] or 0
    both = inside.join(F.broadcast(last) if size <= most_broadcast else last, F.col("_b") == F.col("_to"), "left")
    both = both.select("doc_id", "text", F.coalesce("_n", "_e", F.lit("")).alias("next_text"))
    third = F.floor(F.length("text") / 3).cast("int")
    return both.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), (F.length("text") - third).cast("int")), F.col("next_text").substr(F.lit(1), third)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses."""
    out = with_tree(with_tree(with_tree(edited_pairs(docs), "text", "_a"), "edited", "_e"), "next_text", "_x")
    a, e, x = F.col("_a"), F.col("_e"), F.col("_x")
    before, after = changed(a, e, "paragraphs")
    return out.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        a["root"].alias("fingerprint"), e["root"].alias("edited_fingerprint"), likeness(a, e).alias("near_edited"), likeness(a, x).alias("near_next"),
        F.size(differing(a, e, "paragraphs")).cast("long").alias("n_paragraphs_changed"), before.alias("paragraphs_before"), after.alias("paragraphs_after"),
    )


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text FROM d),
e AS (SELECT *, substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) AS edited FROM n),
t AS (SELECT doc_id, 'a' AS k, text AS t FROM e UNION ALL SELECT doc_id, 'e', edited FROM e UNION ALL SELECT doc_id, 'x', next_text FROM e),
l AS (SELECT doc_id, k, list_transform(string_split(t, chr(10)), lambda p: list_transform(regexp_extract_all(p, '(?s).{1,64}'), lambda x: md5(x))) AS leaves FROM t),
p AS (SELECT doc_id, k, flatten(leaves) AS leaves, list_transform(leaves, lambda x: md5(coalesce(array_to_string(x, ''), ''))) AS paras FROM l),
s AS (SELECT doc_id, k, leaves, paras, regexp_replace(array_to_string(list_transform(paras, lambda h: h || CASE WHEN h < '4' THEN '/' ELSE '' END), ''), '/$', '') AS joined FROM p),
r AS (SELECT doc_id, k, list_distinct(leaves) AS leaves, paras, sha256(array_to_string(list_transform(string_split(joined, '/'), lambda x: md5(x)), '')) AS root FROM s)
SELECT e.doc_id, CAST(length(e.text) AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256, a.root AS fingerprint, b.root AS edited_fingerprint,
  CASE WHEN a.root = b.root THEN 1.0 WHEN len(a.leaves) + len(b.leaves) = 0 THEN 0.0 ELSE 2.0 * len(list_intersect(a.leaves, b.leaves)) / (len(a.leaves) + len(b.leaves)) END::DOUBLE AS near_edited,
  CASE WHEN a.root = x.root THEN 1.0 WHEN len(a.leaves) + len(x.leaves) = 0 THEN 0.0 ELSE 2.0 * len(list_intersect(a.leaves, x.leaves)) / (len(a.leaves) + len(x.leaves)) END::DOUBLE AS near_next,
  CAST(len(list_filter(list_distinct(a.paras), lambda h: NOT list_contains(b.paras, h))) AS BIGINT) AS n_paragraphs_changed,
  CAST(coalesce(nullif(list_position(list_transform(list_zip(a.paras, b.paras), lambda z: coalesce(z[1] = z[2], false)), false), 0) - 1, len(a.paras)) AS BIGINT) AS paragraphs_before,
  CAST(coalesce(nullif(list_position(list_transform(list_zip(list_reverse(a.paras), list_reverse(b.paras)), lambda z: coalesce(z[1] = z[2], false)), false), 0) - 1, len(a.paras)) AS BIGINT) AS paragraphs_after
FROM e JOIN r a ON a.doc_id = e.doc_id AND a.k = 'a' JOIN r b ON b.doc_id = e.doc_id AND b.k = 'e' JOIN r x ON x.doc_id = e.doc_id AND x.k = 'x'
"""
