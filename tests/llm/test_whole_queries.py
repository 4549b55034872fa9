"""Whole queries against brute force, helpers against plain Python, and rows that are odd in every way."""

import base64
import collections
import hashlib
import math
import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import byte_bpe, common, fingerprints, jaccard_join, language_id, mixing, ngram_lm, quality_rules, queries, substring_dedup, token_counts, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TAKEN = ["_h", "_b", "_k", "_mix", "_row", "_src", "_rank", "_doc", "_th", "_spans", "_new", "_quality", "s", "q", "kept", "spans", "score", "h", "u", "v", "node", "component", "a.b", "rank`ed"]


def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with the names that operators use."""
    r = random.Random(9)
    long = " ".join(r.choice(["alpha", "beta", "Γάμμα", "δ"]) + str(r.randint(0, 50)) for _ in range(60_000))
    base = [(1, long), (2, long), (3, ""), (4, None), (5, " \n\t "), (6, "x" * 300_000), (7, "same words again " * 30), (7, "same words again " * 30), (8, "same words again " * 30), (None, "no id " + long[:5000]), (None, None), (9, "\n" * 2000), (10, "p%d\n" * 3)]
    rows = [(d, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 2}", None if i % 5 == 0 else i) for i, (d, t) in enumerate(base)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(TAKEN)])


def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (2, None, None), (7, 1, 0), (None, 1, 1), (8, 0, None)], "doc_id long, quality int, toxic int")


def operators(df, lab):
    bpe = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return {
        "quality": lambda: quality_rules.quality(df, lab), "toxicity": lambda: toxicity.toxicity(df, lab), "dedup": lambda: substring_dedup.dedup(df), "lm": lambda: ngram_lm.lm_scores(df),
        "tokens": lambda: token_counts.count_tokens(df, queries.tokenizer_path("piece_bpe_32k.model")), "jaccard": lambda: jaccard_join.join(df, links=True), "bpe": lambda: byte_bpe.encode_documents(df, bpe, queries.pattern()),
        "language": lambda: language_id.identify_languages(df), "fingerprints": lambda: fingerprints.fingerprints(df), "mixing": lambda: mixing.mix_report(df),
    }


@pytest.mark.parametrize("name", ["quality", "toxicity", "dedup", "lm", "tokens", "jaccard", "bpe", "language", "fingerprints", "mixing"])
def test_odd_rows(spark, name):
    df = odd(spark)
    rows = operators(df, labels(spark))[name]().collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in df.select("doc_id").collect())


def test_stages_on_odd_rows(spark, tmp_path):
    import corpus_pipeline as cp

    lab = labels(spark)
    lab.write.parquet(f"{tmp_path}/labels.parquet")
    df = odd(spark)
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns, name
        got, had = ({(str(r["doc_id"]), r["a.b"], r["rank`ed"]) for r in x.collect()} for x in (out, df))
        assert got <= had, name
    assert dict(cp.STAGES)["byte_bpe"](spark, df, str(tmp_path)).count() == df.count()
    empty = df.where("false")
    for name, stage in cp.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name


def test_op1_base_by_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.op1_quality_rules(spark, SF).collect()}
    docs = queries.table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        t, w = d["text"] or "", WORD.findall(d["text"] or "")
        c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        r = got[d["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed)
        assert not (failed and r["kept"])


def test_op5_by_brute_force(spark):
    voc = set(token_counts.sentencepiece_vocabulary(queries.tokenizer_path("piece_bpe_32k.model")))
    want = {}
    for d in queries.table(spark, SF, "documents").collect():
        n = [token_counts.brute_count(w, voc) for w in WORD.findall(d["text"] or "")]
        want[d["doc_id"]] = (len(n), sum(1 if x < 0 else x for x in n), sum(x < 0 for x in n))
    assert {r["doc_id"]: (r["n_words"], r["n_pieces"], r["n_unknown"]) for r in queries.op5_token_counts(spark, SF).collect()} == want


def test_op10_by_brute_force(spark):
    """A plain earliest-deadline schedule over the whole table gives every block the same slot."""
    from fractions import Fraction

    rows = queries.op10_source_mixing(spark, SF).collect()
    count = collections.Counter(r["source"] for r in rows)
    assert count == collections.Counter(r["source"] for r in queries.table(spark, SF, "documents").collect())
    weight = {k: Fraction(n**0.5) for k, n in count.items()}
    left = {k: -(-n // 8) for k, n in count.items()}
    names, done, slots, t, slot, total = sorted(count), collections.Counter(), {}, 0, 0, sum(weight.values())
    own = collections.Counter()
    while any(left.values()):
        ready = [(math.ceil((own[k] + 1) * total / weight[k]), -weight[k], i, k) for i, k in enumerate(names) if left[k] and math.floor(own[k] * total / weight[k]) <= t]
        k = min(ready)[3]
        slots[k, done[k]] = slot
        done[k] += 1
        own[k] += 1
        left[k] -= 1
        slot, t = slot + 1, t + 1
        if not left[k]:
            own.clear()
            t, total = 0, sum(weight[x] for x in names if left[x])
    assert {(r["source"], r["block"]): r["slot"] for r in rows} == slots
    assert len({(r["slot"], r["offset"]) for r in rows}) == len(rows)


def test_maximal_repeats(spark):
    r = random.Random(2)
    passage = [f"p{i}" for i in range(90)]
    own = lambda k: [f"o{k}x{i}" for i in range(60)]
    rows = [(1, own(1) + passage + own(1)), (2, own(2) + passage[:55] + own(3) + passage[20:] + own(4)), (3, passage[:49]), (4, own(5))]
    r.shuffle(rows)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    assert sorted(map(tuple, substring_dedup.maximal_repeats(df).collect())) == [(2, 60, 55), (2, 175, 70)]


def test_word_hashes():
    r = random.Random(1)
    alphabet = b"abAB \n\t\r\x0b\x0c\x85\x1c\xc3\xa9z"
    told, word = {}, {}
    for k in range(60):
        texts = [bytes(r.choice(alphabet) for _ in range(r.choice([0, 1, 3, 20, 100]))) + b"x" * r.choice([0, 0, 7, 8, 9, 64, 65, 200]) for _ in range(r.randint(0, 12))]
        for lower in (False, True):
            got = common.split_words(pa.array([b"before", *texts], pa.binary()).slice(1) if k % 2 else texts, lower)
            for g, t in zip(got, texts, strict=True):
                for h, w in zip(g.tolist(), (t.lower() if lower else t).split(), strict=True):
                    assert told.setdefault(h, w) == w and word.setdefault(w, h) == h
    assert len(word) > 500


def test_pretokens_by_classes_and_by_pattern():
    enc = byte_bpe.Encoder(queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"), queries.pattern())
    assert enc.kinds is not None
    r = random.Random(3)
    parts = ["a", "B", "é", "1", "²", " ", "  ", "\n", "\t", " ", "\x1c", "\x1f", "'s", "'", "'re", "'l", "l", "'ve", "'d", "!", "。", "漢", "\r\n", "　", " \n", "𠮷"]
    for _ in range(2000):
        texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(r.randint(1, 20))]
        data, starts, size, per = enc.cut(texts)
        raw, at = data.tobytes(), 0
        words = [raw[a : a + b].decode() for a, b in zip(starts.tolist(), size.tolist())]
        for t, n in zip(texts, per.tolist()):
            assert words[at : at + n] == enc.split(t)
            at += n
    plain = byte_bpe.Encoder(queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"), r"\S+|\s+")
    data, starts, size, per = plain.cut(["ab  c", "", "é"])
    assert plain.kinds is None and per.tolist() == [3, 0, 1] and size.tolist() == [2, 2, 1, 2]


def test_bpe_survives_equal_hashes(spark, monkeypatch):
    """Where two pre-tokens share a hash, texts come out right all the same; and decode_ids gives the bytes back."""
    import tiktoken

    import numpy as np

    path = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    enc = byte_bpe.Encoder(path, queries.pattern())
    texts = ["hello there", "other words", ""]
    data, starts, size, per = enc.cut(texts)
    h = common.range_hashes(data, starts, size)
    assert len(np.unique(h)) == 4
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = byte_bpe.encode_documents(df, path, queries.pattern(), keep_ids=True)
    back = {r["doc_id"]: bytes(r["decoded"]).decode() for r in byte_bpe.decode_ids(out, path, queries.pattern()).collect()}
    assert back == dict(enumerate(texts))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=queries.pattern(), mergeable_ranks=ranks, special_tokens={})
    assert {r["doc_id"]: r["ids_sha256"] for r in out.collect()} == {i: hashlib.sha256(",".join(map(str, own.encode_ordinary(t))).encode()).hexdigest() for i, t in enumerate(texts)}


def test_fingerprints_of_many_paragraphs(spark):
    text = lambda k: "\n".join(f"paragraph {k} {i}" for i in range(20_000))
    df = spark.createDataFrame([(1, text(1)), (2, text(2))], "doc_id long, text string")
    began = time.time()
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(df).collect()}
    assert time.time() - began < 40
    assert got[1]["paragraphs_after"] == 0 and 13_300 < got[1]["paragraphs_before"] < 13_700 and got[1]["n_paragraphs_changed"] > 6_000


def test_ranges_of_ids(spark):
    for n in (0, 1, 2, 7, 16, 30):
        cuts = sorted(random.Random(n).sample(range(0, 200, 2), n))
        got = spark.range(-1, 201).select("id", fingerprints.below(F.col("id"), cuts).alias("n")).collect()
        assert all(r["n"] == sum(c < r["id"] for c in cuts) for r in got)
