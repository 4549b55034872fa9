"""Python objects of a batch: they stay a fraction of what the batch holds."""

import tracemalloc

import pyarrow as pa

from docloom.operators import lines
from docloom.plans import rules

TEXTS = [f"{i} before\n[[TABLE_START page=1]]\n" + "a | b\n" * 1000 + "[[TABLE_END]]\nafter" for i in range(3000)]


def peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_rule_programs(spark, monkeypatch):
    df, run, rows = spark.createDataFrame([(0, "")], "i long, text string"), [], []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: run.append(f))
    rules.extract(df, 'v:\n    search text : "e"\n    if found :\n        take right :\n            store(r)\n            set(r)\n')
    b = pa.record_batch({"i": range(len(TEXTS)), "text": TEXTS})
    assert peak(lambda: rows.extend(x.num_rows for x in run[0](iter([b])))) < 10_000_000
    assert sum(rows) == len(TEXTS)


def test_segments_and_pages(spark):
    for cut in (lines.cut_segments(), lines.cut_pages()):
        assert peak(lambda: cut.func(pa.array(TEXTS))) < 20_000_000
    got = lines.cut_segments().func(pa.array([*TEXTS, None, ""])).to_pylist()
    assert [x and len(x) for x in got] == [3] * len(TEXTS) + [None, []]
