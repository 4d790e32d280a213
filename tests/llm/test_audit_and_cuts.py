"""Filter audit and fill-in-middle against brute force, odd rows included."""

import collections
import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from kinoframe.llm import filter_audit as audits
from kinoframe.llm.fill_in_middle import BLOCK, MARKERS, fill_in_middle, restored

DOCS = "doc_id long, text string, lang string"


def audited(rows, labels):
    """The audit by trying all orders on all documents."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    masks = []
    for i, text, lang in rows:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        masks.append((lang or "", fails, i in good, i in toxic))
    out, removed = {}, collections.Counter()
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                at = [m for m in own if not any(m[1][x] for x in order[:k])]
                gone = [m for m in at if m[1][f]]
                unique = sum(1 for m in own if m[1][f] and sum(m[1].values()) == 1)
                out[part, "".join(order), k + 1] = (len(at) - len(gone), len(gone), sum(m[1][f] for m in own) - len(gone), unique, sum(m[2] for m in gone), sum(m[3] for m in gone))
                removed[part, f] += len(gone)
    return {(p, o, k): (*v, removed[p, o[k - 1]]) for (p, o, k), v in out.items()}


def documents():
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(260))
    near = long[:-1] + "~"
    rows = [(i, rng.choice([long, near, long + "x", "", None, "a b", "AB #", " ".join(["same"] * 250), long[:70], long[:70] + "y", long[:70] + "z"]), rng.choice(["en", "de", None, ""])) for i in range(90)]
    rows += [(500, long, "en"), (500, long, "en"), (501, long, "en"), (501, near, "fr"), (None, long, "en"), (None, "only here", None), (502, "é" * 3000 + "ab", "xx"), (503, "é" * 3000 + "ac", "xx"), (504, "é" * 3000 + "ab", "xx")]
    return rows


@pytest.mark.parametrize("most", [audits.BROADCAST_ROWS, 0])
def test_audit(spark, monkeypatch, most):
    monkeypatch.setattr(audits, "BROADCAST_ROWS", most)
    rows = documents()
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 90, 3)] + [(3, 0, 0), (500, 1, 1), (999, 1, 1), (None, 1, 1)]
    labels = [(d, int(q), int(t)) for d, q, t in labels]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("n", "b1", "length", "mask", "part", "_salt", "good", "e")})
    got = audits.filter_audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = audited(rows, labels)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) == want[r["part"], r["filter_order"], r["step"]]
    assert audits.filter_audit(df.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_texts_that_share_their_hashes_are_told_apart(spark, monkeypatch):
    """Equal hashes of unequal texts: the full comparison decides."""
    monkeypatch.setattr(audits, "block_hashes", lambda text: [F.lit(7).cast("long").alias(f"b{k}") for k in (1, 2, 3)])
    rows = [(1, "ab", "en"), (2, "cd", "en"), (3, "ab", "en"), (4, "cd", "en"), (5, "ef", "en"), (6, "abc", "en")]
    got = audits.duplicates(spark.createDataFrame(rows, DOCS).select("doc_id", "text"))
    assert sorted(r["doc_id"] for r in got.collect()) == [3, 4]


def cut_text(i, text):
    t = text or ""
    ws = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    n = len(ws)
    d = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(ws[:a]), "".join(ws[a:b]), "".join(ws[b:])
    form = "plain" if not t or any(x in t for x in MARKERS) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return (i, n, form, None if form == "plain" else len(p), None if form == "plain" else len(m), out, t)


def test_fill_in_middle(spark):
    rng = random.Random(1)
    texts = ["", None, "a", "<P> x", "x<M>", "<S", "héé àb", "€", "日本語 text\nnew\r\n", "ab é" * (BLOCK // 3), "Z" * (BLOCK + 1), "\x00a"]
    texts += ["".join(rng.choice("abC é日\n<SPM>😀.") for _ in range(rng.randrange(60))) for _ in range(600)]
    rows = [*enumerate(texts), (3, "<P> x"), (7, "another text"), (None, "no id here"), (-5, "below zero")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("h1", "output", "n", "form")}).repartition(3)
    got = fill_in_middle(df).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, got)) == sorted(key(cut_text(*r)) for r in rows)
    assert fill_in_middle(df.limit(0)).count() == 0
