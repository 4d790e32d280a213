"""Search expressions and ordered streams against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from kinoframe.operators import matching as m
from kinoframe.operators import search
from kinoframe.streaming import ordered


def brute(e, doc, column=None):
    fields = [doc[column]] if column else list(doc.values())
    fits = lambda q, w: w.startswith(q[:-1]) if q.endswith("*") else w == q
    if isinstance(e, m.Word):
        return any(fits(e.word, w) for f in fields for w in f)
    if isinstance(e, m.Phrase):
        q = e.words.split()
        return any(all(fits(a, b) for a, b in zip(q, f[i : i + len(q)], strict=True)) for f in fields for i in range(len(f) - len(q) + 1))
    if isinstance(e, m.Near):
        return any(i != j and fits(e.one, a) and fits(e.other, b) and abs(i - j) <= e.most + 1 for f in fields for i, a in enumerate(f) for j, b in enumerate(f))
    if isinstance(e, m.In):
        return brute(e.inner, doc, e.column)
    if isinstance(e, m.Not):
        return not brute(e.inner, doc, column)
    return (all if isinstance(e, m.All) else any)(brute(p, doc, column) for p in e.parts)


def test_search_expressions(spark, tmp_path):
    rng = random.Random(5)
    pool = "ant ante bee cat dog".split()
    docs = [(i, None if i == 3 else " ".join(rng.choices(pool, k=rng.randrange(9))), rng.choice(["ant bee", "dog", "", None])) for i in range(200)]
    m.write_postings(spark.createDataFrame(docs, "id long, body string, title string"), "id", ["body", "title"], str(tmp_path))
    index, lengths = spark.read.parquet(f"{tmp_path}/postings"), spark.read.parquet(f"{tmp_path}/lengths")
    asked = [
        m.Word("ANT"), m.Word("ant*"), m.Word("a*"), m.Phrase("ant bee cat"), m.Near("ant", "dog", 0), m.Near("ant", "ant", 2), m.In("title", m.Word("bee")),
        m.All(m.Word("cat"), m.Not(m.Any(m.Word("dog"), m.Phrase("bee bee")))), m.Any(m.All(m.Word("ant"), m.Word("bee")), m.In("body", m.Near("cat", "dog", 1))), m.All(m.In("title", m.Not(m.Word("dog"))), m.Word("cat")),
        m.Word("nothing"),
    ]
    for e in asked:
        got = {r["id"] for r in m.found(index, lengths, "id", ["body", "title"], e).collect()}
        assert got == {i for i, a, b in docs if brute(e if e != m.Word("ANT") else m.Word("ant"), {"body": (a or "").split(), "title": (b or "").split()})}, e
    for bad in (m.Not(m.Word("ant")), m.Any(m.Word("ant"), m.Not(m.Word("bee"))), m.All(), m.In("foot", m.Word("ant"))):
        with pytest.raises(ValueError):
            m.found(index, lengths, "id", ["body", "title"], bad)
    plan = m.found(index, lengths, "id", ["body", "title"], m.Word("bee"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket" in plan.split("PartitionFilters")[1][:60]


def test_most_frequent_words(spark):
    rows = [(1, "the cat The dog cat dog dog emu"), (2, None), (3, ""), (4, "ox is a"), (5, "zebra ant zebra ant bee")]
    got = {(r["id"], r["rank"]): (r["tag"], r["n"]) for r in search.keyword_tags(spark.createDataFrame(rows, "id long, text string"), "id", "text", 2).collect()}
    assert got == {(1, 1): ("dog", 3), (1, 2): ("cat", 2), (5, 1): ("zebra", 2), (5, 2): ("ant", 2)}


@pytest.mark.parametrize("name", ["mean", "packing"])
def test_streams_in_any_order(spark, tmp_path, name):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), i, rng.randrange(500), None if i % 11 == 0 else float(rng.randrange(50))) for i in range(160)]
    rows += [rows[0], rows[5]]  # what comes again counts once
    rng.shuffle(rows)
    at = F.timestamp_seconds(F.col("s") * 60)
    df = spark.createDataFrame(rows, "k string, id long, s long, value double").withColumn("ts", at)
    for part in range(4):
        df.filter(F.col("id") % 4 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    fold = ordered.Mean(0.3) if name == "mean" else ordered.Packing(3600.0)
    prepare = lambda s: s.withColumn("start", (F.col("s") * 60).cast("double")).withColumn("end", F.col("s") * 60 + F.coalesce("value", F.lit(0.0)))
    columns = ["id", "value"] if name == "mean" else ["id", "start", "end"]
    got = ordered.folded(spark, str(tmp_path / "in"), "k", "ts", "id", columns, fold, "30 days", files=1, prepare=prepare).collect()
    want, state = {}, {}
    for k, i, s, v in sorted(set(rows), key=lambda r: (r[2], r[1])):
        if name == "mean":
            state[k] = state.get(k) if v is None else v if state.get(k) is None else 0.3 * v + 0.7 * state[k]
            want[i] = state[k]
        else:
            begin, number = state.get(k, (None, -1))
            if begin is None or s * 60 + (v or 0.0) - begin > 3600:
                begin, number = s * 60.0, number + 1
            state[k] = (begin, number)
            want[i] = number
    assert len(got) == len(want) and {r["id"]: r[2] for r in got} == pytest.approx(want) if name == "packing" else all((want[r["id"]] is None and r[2] is None) or abs(r[2] - want[r["id"]]) < 1e-9 for r in got)
    assert len(got) == len(want)


def test_segment_tags_shuffle_no_texts_with_words(spark):
    """Of words equally frequent the first one leads, by time, then text, then place; texts are no part of what is counted."""
    import re

    rows = [(1, 0.0, "zebra apple apple zebra of"), (1, 0.0, "mango pear pear"), (1, 0.0, "mango pear pear"), (1, None, "quince"), (2, 1.0, None), (3, 1.0, "plum fig fig"), (3, 2.0, "plum date")]
    df = spark.createDataFrame(rows, "k int, t double, text string")
    out = search.segment_label(df, ["k"], "t", "text", tags=4)
    assert {r["k"]: (r["n"], r["tags"]) for r in out.collect()} == {1: (4, ["pear", "mango", "zebra", "apple"]), 2: (1, []), 3: (2, ["plum", "fig", "date"])}
    assert not re.search(r"min\(struct\([^)]*text", out._jdf.queryExecution().optimizedPlan().toString())


def test_postings_need_no_shuffle(spark):
    """A text's words are brought together in its own row, in any number of batches."""
    df = spark.createDataFrame([(i, None if i == 3 else "" if i == 4 else f"b a{chr(97 + i % 5)} b" if i % 2 else "a b a") for i in range(1100)], "id long, text string").coalesce(1)
    out = search.postings(df, "id", "text")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    want = set()
    for i, text in df.collect():
        words = (text or "").split()
        want |= {(w, i, words.count(w), tuple(k for k, x in enumerate(words) if x == w), len(words)) for w in words}
    assert {(r["term"], r["id"], r["n"], tuple(r["places"]), r["length"]) for r in out.collect()} == want


def test_waiting_rows_lie_in_blocks():
    """A state's entries are as many as blocks, not as rows, and hold all of them in order."""
    rows = [(i, None if i % 3 else i, f"v{i}") for i in range(2 * ordered.BLOCK + 5)]
    blocks = ordered._blocks(rows)
    assert len(blocks) == 3 and [r for b in blocks for r in zip(*b, strict=True)] == rows and ordered._blocks([]) == []


def _shuffled_rows(plan) -> int:
    """Rows that a query which has run sent through its shuffles."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _shuffled_rows(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _shuffled_rows(plan.plan())
    written = plan.metrics().get("shuffleRecordsWritten")
    children = plan.children()
    return (written.get().value() if written.isDefined() else 0) + sum(_shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_segment_tags_shuffle_texts_and_few_words(spark):
    """Words of a segment that lies in one batch are counted and cut there: captions and a segment's tags are shuffled, not all words."""
    rng = random.Random(3)
    df = spark.createDataFrame([(i // 5, i % 5, " ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(60))) for i in range(2000)], "k int, t int, text string")
    out = search.segment_label(df, ["k"], "t", "text", tags=3).select("k", "tags")
    assert len(out.collect()) == 400
    assert _shuffled_rows(out._jdf.queryExecution().executedPlan()) < 10_000  # of 120,000 words


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_segment_tags_of_segments_of_any_size(spark, batch):
    """Segments that go on in other batches and ranges, a large one, nulls, and signed zeros in keys."""
    rng = random.Random(batch)
    pool = "ant bee cat dog emu fox gnu hen of an".split()
    sizes = [(None, 4), (-0.0, 9), (0.0, 9), (1.5, 300), (2.5, 1), (float("nan"), 5)] + [(float(k), rng.randrange(1, 6)) for k in range(10, 60)]
    rows = [(k, [name], rng.choice([None, 0, 1, 2]), rng.choice([None, "", " ".join(rng.choices(pool, k=rng.randrange(1, 9)))])) for k, n in sizes for _ in range(n) for name in (["x", "y"][rng.randrange(2)],)]
    rng.shuffle(rows)
    want = {}
    for k, name, t, text in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3] is not None, r[3] or "")):
        counts = want.setdefault((repr(k + 0.0 if k is not None else k), name[0]), {})
        for w in (text or "").split():
            if len(w) > 2:
                counts[w] = counts.get(w, 0) + 1  # in the order in which words are seen
    default = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = search.segment_label(spark.createDataFrame(rows, "k double, name array<string>, t int, text string").repartition(3), ["k", "name"], "t", "text", tags=4).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", default)
    top = {k: sorted(c, key=lambda w: -c[w])[:4] for k, c in want.items()}
    assert {(repr(r["k"] + 0.0 if r["k"] is not None else None), r["name"][0]): r["tags"] for r in got} == {k: [] if k[0] == "None" else v for k, v in top.items()}
