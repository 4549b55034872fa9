"""The corpus operators against brute force on small fixtures."""

import base64
import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from docloom.llm import byte_bpe, fingerprints, jaccard_join, language_id, mixing, ngram_lm, quality_rules, queries, substring_dedup, token_counts, toxicity
from tests.oracle import differences

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, s string, kept string"


def fixture(spark, seed=1):
    """Random texts over few words, with copies, edits, empty, null, tied and repeated rows and clashing columns."""
    r = random.Random(seed)
    voc = ["w%d" % i for i in range(400)] + ["É1", "ß", "𠮷"]
    rows = []
    for i in range(120):
        if i % 4 and rows and i % 3:
            w = r.choice(rows)[1].split()
            for _ in range(r.randint(0, 3)):
                if w:
                    w[r.randrange(len(w))] = r.choice(voc)
        else:
            w = [r.choice(voc) for _ in range(r.choice([0, 1, 3, 6, 9, 14, 60, 200]))]
        if i % 10 == 0 and rows:
            w += r.choice(rows)[1].split()[:70]
        rows.append((i, r.choice([" ", "\n"]).join(w)))
    rows += [(500, ""), (501, " \n "), (502, "x" * 50_000), (7, rows[7][1])]
    out = [(a, b, "en", "s%d" % (a % 3), len(b), "x", "y") for a, b in rows]
    return rows, spark.createDataFrame([*out, (600, None, None, None, None, None, None)], SCHEMA)


def test_substring_dedup(spark):
    rows, df = fixture(spark)
    got = {r[0]: r for r in substring_dedup.dedup(df).collect()}
    first = {}
    for d, t in sorted(rows):
        w = WORD.findall(t)
        mask = [0] * len(w)
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            if first.setdefault(k, d) < d:
                mask[i : i + 50] = [1] * 50
        kept = " ".join(x for x, m in zip(w, mask) if not m)
        assert tuple(got[d])[:4] == (d, len(w), sum(mask), hashlib.sha256(kept.encode()).hexdigest())
    assert got[600]["n_words"] == 0
    assert sum(r["n_removed"] for r in got.values()) > 0


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, seed):
    rows, df = fixture(spark, seed)
    got = {r[0]: r for r in jaccard_join.join(df).collect()}
    sets = {}
    for d, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[d] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    comp = {d: d for d in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            changed |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    assert links
    for d in sets:
        assert (got[d]["n_shingles"], got[d]["component_id"]) == (len(sets[d]), comp[d])
    assert (got[600]["n_shingles"], got[600]["component_id"]) == (0, 600)


def test_byte_bpe_as_tiktoken(spark):
    import tiktoken

    path = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=queries.pattern(), mergeable_ranks=ranks, special_tokens={})
    rows, df = fixture(spark)
    odd = [(700, "a  b\t\n　x\x1c\x85 it's 12345   你好𠮷 <|endoftext|>"), (701, "ab" * 3000)]
    df = df.unionByName(spark.createDataFrame(odd, "doc_id long, text string"), allowMissingColumns=True)
    got = {r[0]: r for r in byte_bpe.encode_documents(df, path, queries.pattern(), keep_ids=True).collect()}
    for d, t in rows + odd:
        ids = enc.encode_ordinary(t)
        assert list(got[d]["ids"]) == ids and got[d]["n_tokens"] == len(ids)
        assert got[d]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert got[600]["n_tokens"] == 0


def test_token_counts(spark):
    voc = {"▁un", "▁aff", "able", "a", "▁a", "b", "ab", "abc", "▁ab", "c", "bcd", "x"}
    count = token_counts.Counter(voc)
    r = random.Random(3)
    for _ in range(3000):
        w = "".join(r.choice("abcdxun") for _ in range(r.randint(1, 9)))
        assert count(w) == token_counts.brute_count(w, voc), w
    _, df = fixture(spark)
    got = token_counts.count_tokens(df, queries.tokenizer_path("piece_bpe_32k.model")).collect()
    assert len(got) == df.count() and {r["n_pieces"] for r in got if r["doc_id"] in (500, 600)} == {0}


def test_fingerprints_oracle(spark):
    assert not differences(spark, queries.op9_fingerprints, fingerprints.ORACLE, SF)


def test_fingerprints_odd_rows(spark):
    _, df = fixture(spark)
    got = fingerprints.fingerprints(df).collect()
    assert len(got) == df.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (500, 600)}) == 1


def test_quality_statistics():
    for t in ["", "a b c d e f g h " * 3, "x | y\n\nx | y\n#1 $", "q " * 7]:
        w = WORD.findall(t)
        c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = set()
        for i in range(len(w) - 7):
            if c[tuple(w[i : i + 8])] > 1:
                hit |= set(range(i, i + 8))
        seen, dup = set(), 0
        for x in t.split("\n"):
            if WORD.search(x):
                dup += x in seen
                seen.add(x)
        assert quality_rules.measure(t)[:5] == (len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), dup, len(hit))


def test_quality_rules(spark):
    rng = np.random.default_rng(1)
    x = rng.random((2000, len(quality_rules.FEATURES)))
    bad = (x[:, 1] > 0.8) | ((x[:, 4] > 0.7) & (x[:, 6] < 0.3))
    rules = quality_rules.learn_rules(x, bad)
    m = np.zeros(2000, bool)
    for r in rules:
        m |= quality_rules._covers(r, x, quality_rules.FEATURES)
    assert (m == bad).mean() > 0.97
    _, df = fixture(spark)
    out = quality_rules.quality(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert out.count() == df.count() and out.where("kept AND base_failed").count() == 0


def test_toxicity_field_is_exact():
    f = toxicity.Field({b"bad": 2.0, b"ok": -1.0}, [0.1, 0.0, 0.0, 0.0], -0.5, -0.3, [[0.4, -0.2], [0.1, 0.7]])
    docs = [[b"ok", b"bad", b"bad"], [b"bad"], [], [b"x", b"ok"]]
    e = [[f.emission(w) for w in d] for d in docs]
    p = f.marginals(np.array([x for d in e for x in d]), np.array([len(d) for d in docs]))
    want = []
    for d in e:
        paths = {}
        for k in range(2 ** len(d)):
            y = [k >> i & 1 for i in range(len(d))]
            paths[tuple(y)] = math.exp(sum(a * b for a, b in zip(d, y)) + (f.start if y and y[0] else 0) + sum(f.trans[a][b] for a, b in zip(y, y[1:])))
        z = sum(paths.values())
        want += [sum(v for y, v in paths.items() if y[i]) / z for i in range(len(d))]
    assert np.allclose(p, want)


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op2_toxicity(spark, d).collect()}
    lab = spark.read.parquet(f"{d}/labels.parquet").collect()
    ok = [got[r["doc_id"]]["predicted"] == r["toxic"] for r in lab if got[r["doc_id"]]["held_out"]]
    assert np.mean(ok) > 0.9


def test_language_id(spark):
    auto = language_id.Automata({"aa": "abcabcabd"})
    s = "abcxabd"

    def brute(t):
        n = i = 0
        while i < len(t):
            j = i + 1
            while j <= len(t) and t[i:j] in "abcabcabd":
                j += 1
            i, n = max(j - 1, i + 1), n + 1
        return n

    seq = auto.symbol[language_id.normal(s)]
    assert auto.phrases(seq, np.array([len(s)]))[0, 0] == brute(s)
    r = random.Random(8)
    many = ["".join(r.choice("abcdx") for _ in range(r.randint(1, 40))) for _ in range(50)]
    seqs = np.concatenate([auto.symbol[language_id.normal(x)] for x in many])
    assert auto.phrases(seqs, np.array([len(x) for x in many]))[0].tolist() == [brute(x) for x in many]
    d = queries.table(spark, SF, "documents")
    got = {r["doc_id"]: r for r in language_id.identify_languages(d).collect()}
    ok = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in d.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean(ok) > 0.9
    _, df = fixture(spark)
    assert {r["lang_pred"] for r in language_id.identify_languages(df).collect() if r["doc_id"] in (500, 501, 600)} == {"und"}


def test_language_model(spark):
    rows, df = fixture(spark)
    got = {r["doc_id"]: r for r in ngram_lm.lm_scores(df).collect()}
    import zlib

    c, pair = collections.Counter(), collections.Counter()
    every = rows + [(600, "")]
    for d, t in every:
        if zlib.crc32(str(d).encode()) % 5 != 1:
            w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t)] + ["</s>"]
            c.update(w)
            pair.update(zip(["<s>", *w[:-1]], w))
    n, v = sum(c.values()), len(c)
    hist = collections.Counter(w for _, w in pair)
    ctx = collections.Counter()
    for (a, _), k in pair.items():
        ctx[a] += k
    d2 = ngram_lm.discounts([sum(k == i for k in pair.values()) for i in (1, 2, 3, 4)])
    d1 = ngram_lm.discounts([sum(k == i for k in hist.values()) for i in (1, 2, 3, 4)])
    left1 = sum(d1[min(k, 3) - 1] for k in hist.values()) / len(pair)
    left = collections.Counter()
    for (a, _), k in pair.items():
        left[a] += d2[min(k, 3) - 1] / ctx[a]

    def p(a, b):
        one = (max(hist[b] - d1[min(hist[b], 3) - 1], 0) if hist[b] else 0) / len(pair) + left1 / (v + 1)
        if not ctx[a]:
            return one
        k = pair[a, b]
        return (k - d2[min(k, 3) - 1] if k else 0) / ctx[a] + left[a] * one

    for d, t in every:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t)] + ["</s>"]
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w], w)), rel_tol=1e-5)


def test_mixing(spark):
    blocks, weight = {"a": 70, "b": 31, "c": 9}, {"a": 5.0, "b": 3.0, "c": 2.0}
    plan = mixing.phases(blocks, weight, 100)
    at = {}
    for phase, k, first, n, start, part, period, slots in plan:
        for j in range(n):
            s = start + j // part * period + slots[j % part]
            assert s not in at
            at[s] = k
    assert len(at) == 110 and sorted(at) == list(range(110))
    end = min(max(s for s in at if at[s] == k) for k in blocks) + 1
    done = collections.Counter()
    for t in range(end):
        done[at[t]] += 1
        assert all(abs(done[k] - (t + 1) * weight[k] / 10) < 1 for k in blocks)
    _, df = fixture(spark)
    got = mixing.mix_sources(df, block_rows=4).collect()
    assert len(got) == df.count() and len({(r["_mix"]["slot"], r["_mix"]["offset"]) for r in got}) == len(got)


def test_empty_tables(spark):
    e = spark.createDataFrame([], SCHEMA)
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    for out in (
        quality_rules.quality(e, lab), toxicity.toxicity(e, lab), substring_dedup.dedup(e), ngram_lm.lm_scores(e), token_counts.count_tokens(e, queries.tokenizer_path("piece_bpe_32k.model")),
        jaccard_join.join(e), byte_bpe.encode_documents(e, path, queries.pattern()), language_id.identify_languages(e), fingerprints.fingerprints(e), mixing.mix_report(e),
    ):
        assert out.count() == 0


def test_pipeline(spark):
    """Each stage on its own input, against the operators' own results."""
    import corpus_pipeline as cp

    docs = queries.table(spark, SF, "documents")
    stage = dict(cp.STAGES)
    one = stage["quality_rules"](spark, docs, SF)
    assert one.columns == docs.columns
    two = stage["ngram_jaccard_join"](spark, one, SF)
    assert two.count() == jaccard_join.join(one).where("doc_id = component_id").count()
    three = stage["substring_dedup"](spark, two, SF)
    sums = {r["doc_id"]: r["kept_sha256"] for r in substring_dedup.dedup(two).collect()}
    assert all(hashlib.sha256(b" ".join(r["text"].encode().split())).hexdigest() == sums[r["doc_id"]] for r in three.collect())
    four = stage["source_mixing"](spark, three, SF)
    assert four.count() == three.count() and four.columns == docs.columns
    assert cp.run(spark, SF).count() == four.count()


def test_jaccard_join_long_texts(spark):
    """Places on the lists of very long texts pass a thousand."""
    base = [f"w{i}" for i in range(16_000)]
    near = base[:-200] + [f"x{i}" for i in range(200)]
    far = base[:8_000] + [f"y{i}" for i in range(8_000)]
    df = spark.createDataFrame([(3, " ".join(near)), (2, " ".join(base)), (1, " ".join(far))], "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.join(df).collect())) == [(1, 15_997, 1), (2, 15_997, 2), (3, 15_997, 2)]


def test_token_counts_lone_start(spark):
    """Words without a piece that starts with their first character begin with the piece of the start alone."""
    path = queries.tokenizer_path("piece_bpe_32k.model")
    voc = set(token_counts.sentencepiece_vocabulary(path))
    assert "▁" in voc
    count = token_counts.Counter(voc)
    words = ["1990", "你好", "Ελλάδα", "3.14", "日本語", "a▁b", "▁", "house", "\U00020bb7"]
    for w in words:
        best, i = 0, 0
        whole = "▁" + w
        while i < len(whole) and best >= 0:
            j = max((j for j in range(i + 1, len(whole) + 1) if whole[i:j] in voc), default=None)
            best, i = (best + 1, j) if j else (-1, i)
        assert count(w) == token_counts.brute_count(w, voc) == best, w
    assert (count("1990"), count("你好"), count("Ελλάδα")) == (5, 3, 7)
    r, small = random.Random(4), {"▁", "▁ab", "▁abc", "a", "b", "bc", "▁b", "cab"}
    count = token_counts.Counter(small)
    for _ in range(3000):
        w = "".join(r.choice("abc▁") for _ in range(r.randint(1, 9)))
        assert count(w) == token_counts.brute_count(w, small), w
    got = token_counts.count_tokens(spark.createDataFrame([(1, "1990 你好 Ελλάδα")], "doc_id long, text string"), path).collect()
    assert [tuple(x) for x in got] == [(1, 3, 15, 0)]


def most_off(blocks, target, length):
    """The largest deviation from the target weights at any slot, in blocks (exact), and the number of slots."""
    from fractions import Fraction

    plan = mixing.phases(blocks, target, length)
    live = collections.defaultdict(list)
    for row in plan:
        live[row[0]].append(row)
    names, worst, slots = set(blocks), Fraction(0), 0
    left = dict(blocks)
    for phase in sorted(live):
        total = sum(Fraction(target[k]) for k in names if left[k])
        for _, k, first, n, _, _, period, at in live[phase]:
            w = Fraction(target[k]) / total
            assert first == blocks[k] - left[k] and at == sorted(at)
            worst = max(worst, w * period - n, *(max(j + 1 - w * (t + 1), w * t - j) for j, t in enumerate(at)))
            left[k] -= n
            slots += n
        names = {k for k in names if left[k]}
    assert not names
    return worst, slots


def test_mixing_exact_weights():
    """Less than a block from the target weights themselves: irrational weights, long runs, thousands of sources."""
    blocks = {f"s{i:02d}": 300 + 37 * i for i in range(20)} | {"hot": 20_000}
    worst, slots = most_off(blocks, mixing.root_weights(blocks), 5_000)
    assert worst < 1 and slots == sum(blocks.values())
    many = {f"s{i:04d}": 400 if i < 4 else 4 for i in range(2_047)} | {"hot": 300}
    worst, slots = most_off(many, {k: 31 / 2048 if k == "hot" else 2017 / 2048 / 2_047 for k in many}, 3_777)
    assert worst < 1 and slots == sum(many.values())


def test_mixing_many_sources(spark):
    """More sources than 4,096, and places that do not depend on the ranges; a null source among them."""
    df = spark.range(15_000).selectExpr("id AS doc_id", "CASE WHEN id % 5000 > 0 THEN CAST(id % 5000 AS STRING) END AS source")
    got = sorted((r["_mix"]["slot"], r["_mix"]["offset"], r["doc_id"]) for r in mixing.mix_sources(df, block_rows=2).collect())
    assert len(got) == 15_000 and {g[0] for g in got} == set(range(10_000)) and len({g[:2] for g in got}) == 15_000
    few = df.where("doc_id < 2000").selectExpr("doc_id", "CAST(doc_id % 7 AS STRING) AS source")
    one, other = ({r["doc_id"]: r["_mix"] for r in mixing.mix_sources(few, range_slots=n).collect()} for n in (30, 100_000))
    assert one == other


def test_pipeline_near_copies(spark):
    """The pipeline's stage takes five words and 80 %: near copies that four words and 85 % keep apart."""
    import corpus_pipeline as cp

    rows, r = [], random.Random(5)
    for i, (n, changed) in enumerate([(1_000, 21), (1_000, 22), (500, 11), (200, 4), (200, 6)]):
        base = [f"a{i}x{j}" for j in range(n)]
        near = list(base)
        for c in range(changed):
            near[(2 * c + 1) * n // (2 * changed)] = f"b{i}x{c}"
        r.shuffle(rows)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(near))]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def linked(words, percent):
        sets = {d: {tuple(t.split()[i : i + words]) for i in range(len(t.split()) - words + 1)} for d, t in rows}
        return {d for d in range(0, 10, 2) if 100 * len(sets[d] & sets[d + 1]) >= percent * len(sets[d] | sets[d + 1])}

    assert linked(5, 80) == {0, 2, 4, 6} and not linked(4, 85)
    assert {x["doc_id"] for x in dict(cp.STAGES)["ngram_jaccard_join"](spark, df, SF).collect()} == {0, 2, 4, 6, 8, 9}
    assert {x["doc_id"]: x["n_shingles"] for x in jaccard_join.join(df, 80, shingle=5).collect()}[0] == 996
    assert jaccard_join.keep_one(df).count() == 10


@pytest.mark.parametrize("block", [2, 128])
def test_jaccard_join_links(spark, monkeypatch, block):
    """Links of every row, in chains, cliques and among copies, also where a component takes several blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    rows, df = fixture(spark)
    base = [f"c{i}" for i in range(100)]
    chain = [(800 + i, " ".join([f"d{j}" for j in range(3 * i)] + base[3 * i :])) for i in range(9)]
    clique = [(900 + i, " ".join([*(f"k{j}" for j in range(90)), f"e{i // 2}"])) for i in range(12)]
    every = rows + chain + clique
    df = df.unionByName(spark.createDataFrame(chain + clique, "doc_id long, text string"), allowMissingColumns=True)
    sets = []
    for d, t in every:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    want = sorted((d, sum(i != j and bool(s) and 100 * len(s & o) >= 85 * len(s | o) for j, o in enumerate(sets))) for i, ((d, _), s) in enumerate(zip(every, sets)))
    got = sorted((r["doc_id"], r["n_links"]) for r in jaccard_join.join(df, links=True).collect())
    assert got == sorted([*want, (600, 0)])
    assert dict(got)[900] == 11 and 0 < dict(got)[800] < 8


def test_language_id_alphabets():
    """Large alphabets keep all their letters, as a table and as sorted transitions."""
    r = random.Random(6)
    alphabet = {"han": range(0x4E00, 0x4E00 + 900), "han2": range(0x4E00 + 900, 0x4E00 + 1800), "hangul": range(0xAC00, 0xAC00 + 900), "beyond": range(0x20000, 0x20000 + 900), "beyond2": range(0x20000 + 900, 0x20000 + 1800), "greek": range(0x3B1, 0x3CA), "latin": range(0x61, 0x7B)}

    def text(k, n):
        return "".join(" " if r.random() < 0.1 else chr(r.choice(alphabet[k])) for _ in range(n))

    samples = {k: text(k, 3_000) for k in alphabet}
    texts = [text(k, 60) for k in alphabet for _ in range(5)]
    table, way = language_id.Automata(samples), language_id.Automata(samples, cells=0)
    assert (table.symbol[language_id.normal("".join(samples.values()))] > 0).all()
    assert table.score(texts)[0] == [k for k in alphabet for _ in range(5)]
    assert way.score(texts) == table.score(texts)


def test_language_id_many_languages(spark):
    """A language past the sixty-fourth is told too, and one that only short texts have."""
    r = random.Random(7)
    voc = {f"l{i:02d}": ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)] for i in range(70)}
    rows = [(100 * i + j, " ".join(r.choices(v, k=10 if i == 69 else 60)), k) for i, (k, v) in enumerate(voc.items()) for j in range(8)]
    got = {x["doc_id"]: x for x in language_id.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    held = [(got[d]["lang_pred"], k) for d, _, k in rows if got[d]["held_out"]]
    assert len({k for _, k in held}) > 64 and all(a == b for a, b in held)
