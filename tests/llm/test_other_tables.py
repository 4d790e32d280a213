"""Operators on vectors, urls and languages, components, and the pipeline, against brute force."""

import collections
import datetime
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinoframe.llm import embedding_dedup
from kinoframe.llm.embedding_dedup import near_duplicate_vectors, passes_for
from kinoframe.llm.graph import components
from kinoframe.llm.language_id import Pieces, held_out, learn_languages, predict_languages
from kinoframe.llm.quality import BOILERPLATE, NAVIGATION, TERMINAL
from kinoframe.llm.url_filter import list_intervals, url_verdicts

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def roots(nodes, links):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("n, m", [(1, 0), (40, 30), (60, 200)])
def test_components(spark, n, m):
    rng = random.Random(n)
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + ([(i, i + 1) for i in range(n, n + 25)] if m else [])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links for x in p if p[0] != p[1]}
    assert got == roots(nodes, [p for p in links if p[0] != p[1]])


def vector_rows():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    rows = [(i, rng.standard_normal(16).tolist(), i % 3) for i in range(150)]
    for k, b in enumerate(base):
        rows += [(1000 + 40 * k + j, (b + 0.05 * rng.standard_normal(16)).tolist(), k % 2) for j in range(1 + 3 * k)]
    rows += [(3000 + j, base[0].tolist(), 0) for j in range(5)]
    rows += [(4000, None, 0), (4001, [0.0] * 16, 0), (4002, [float("nan")] * 16, 0), (4003, [None] + [1.0] * 15, 0), (4004, base[0].tolist(), None), (4005, base[0].tolist()[:8], 0), (4006, [], 0)]
    return [*rows, rows[0], (None, base[0].tolist(), 0)]


def test_vectors(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "vec_id long, embedding array<float>, label int, component_id string, n_links int")
    got = near_duplicate_vectors(df).collect()
    assert len(got) == len(rows)
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            good[i] = (label, x / np.linalg.norm(x))
    ids = sorted(good)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.93]
    root, degree = roots([r[0] for r in rows if r[0] is not None], links), collections.Counter(x for p in links for x in p)
    for r in got:
        i = r["vec_id"]
        assert (r["component_id"], r["n_links"], r["kept"]) == ((root[i], degree[i], root[i] == i) if i is not None else (None, 0, True))
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def test_vectors_beside_columns_of_its_own_names(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 1), (4, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    names = ("vector", "dims", "rep", "copies", "n", "h1", "component", "node", "n_links", "kept", "_salt", "tiles")
    got = near_duplicate_vectors(df.withColumns({c: F.lit("x") for c in names}))
    assert sorted(map(tuple, got.select("vec_id", "n_links", "component_id", "kept").collect())) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


@pytest.mark.parametrize("mean", [0.6, 0.8])
def test_recall_among_many_vectors_of_one_label(spark, mean):
    """20,000 vectors with a mean cosine, and 400 pairs at 0.93 to 0.95: at least 99 of 100 links are found."""
    rng, n = np.random.default_rng(5), 20_000
    shared = rng.standard_normal(64)
    x = np.sqrt(mean) * shared / np.linalg.norm(shared) + np.sqrt(1 - mean) * rng.standard_normal((n, 64)) / 8
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c, t, d = x[:400], rng.uniform(0.93, 0.95, 400)[:, None], rng.standard_normal((400, 64))
    d -= (d * c).sum(1, keepdims=True) * c
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    y = np.r_[x, t * c + np.sqrt(1 - t * t) * d].astype(np.float32)
    z = y.astype(float) / np.linalg.norm(y.astype(float), axis=1, keepdims=True)
    true = sum(int((z[k : k + 1000] @ z.T >= 0.93).sum()) for k in range(0, len(z), 1000)) - len(z)
    df = spark.createDataFrame(list(zip(range(len(y)), y.tolist(), [0] * len(y))), "vec_id long, embedding array<float>, label int")
    found = near_duplicate_vectors(df).agg(F.sum("n_links")).first()[0]
    assert true >= 800 and 0.99 * true <= found <= true


@pytest.mark.parametrize("queries", [8192, 700])
def test_vectors_that_share_a_direction(spark, queries):
    """Mean cosine 0.88 inside one label, 0.8 in the other, and noisy copies: links lost by the target recall at most."""
    rng = np.random.default_rng(8)
    rows = []
    for label, (n, mean) in enumerate(((2200, 0.88), (1800, 0.8))):
        shared = rng.standard_normal(64)
        x = np.sqrt(mean) * shared / np.linalg.norm(shared) + np.sqrt(1 - mean) * rng.standard_normal((n, 64)) / 8
        copies = x[:150] + 0.15 * np.sqrt(1 - mean) * rng.standard_normal((150, 64)) / 8
        rows += [(10_000 * label + i, v.tolist(), label) for i, v in enumerate([*x, *copies])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in near_duplicate_vectors(df, queries=queries).collect()}
    links = lost = 0
    for label in (0, 1):
        ids = np.array([r[0] for r in rows if r[2] == label])
        x = np.array([r[1] for r in rows if r[2] == label])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        true = (x @ x.T >= 0.93).sum(1) - 1
        links, lost = links + true.sum(), lost + (true - [got[i]["n_links"] for i in ids]).sum()
    assert links > 600 and 0 <= lost <= 0.001 * links


def test_every_label_goes_through_the_passes(spark, monkeypatch):
    """No label is compared all against all: what the passes find is the result."""
    monkeypatch.setattr(embedding_dedup, "_exact_links", None)
    monkeypatch.setattr(embedding_dedup, "_tile_forest", None)
    df = spark.createDataFrame(vector_rows(), "vec_id long, embedding array<float>, label int")
    assert near_duplicate_vectors(df).filter("n_links > 0").count() > 100


@pytest.mark.parametrize("tile", [7, 1024])
def test_labels_finished_exactly(spark, monkeypatch, tile):
    """Without rounds of passes the pruned tiles alone find all links."""
    monkeypatch.setattr(embedding_dedup, "ROUNDS", 0)
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    test_vectors(spark)


def test_passes_grow_with_the_rows_and_the_recall():
    assert passes_for(0.93, 0.99, 100, 32) <= passes_for(0.93, 0.99, 10**6, 32) <= passes_for(0.93, 0.9999, 10**6, 32)


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def test_urls(spark):
    rng = random.Random(2)
    hosts = ["a.example.com", "b.a.example.com", "example.org", "x.org", "A.Example.COM", "u:p@x.org:80"]
    captures = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['', 'en/1', 'de?x=/y', 'en#t'])}", day(rng.randrange(40))) for i in range(300)]
    captures += [captures[0], captures[0], (900, None, day(1)), (901, "no url", day(1)), (902, "http://x.org/", None), (None, "http://x.org/", day(3)), (903, "http://" + "a." * 400 + "example.com/", day(9))]
    rules = ["example.com", "a.example.com", "a.example.com/en", "org", "x.org", "com"]
    entries = [(rng.choice("LM"), rng.choice(rules), None, rng.random() < 0.6, day(rng.randrange(40))) for _ in range(120)]
    entries = [(a, b, a == "L", c, d) for a, b, _, c, d in entries]
    e = spark.createDataFrame(entries, "list string, rule string, blocks boolean, adds boolean, at date")
    got = url_verdicts(spark.createDataFrame([(*c, "h") for c in captures], "page_id long, url string, fetched date, host string"), e)
    assert got.count() == len(captures)

    def brute(url, at):
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        host = (m[1].lower() if m else "") or None
        if host is None or at is None:
            return host, 0, "none", None
        labels = host.split(".")
        keys = {".".join(labels[k:]) for k in range(len(labels))}
        seg = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", url)
        if seg:
            keys.add(f"{host}/{seg[1]}")
        active = []
        for lst in "LM":
            for rule in keys:
                past = sorted({(d, c) for a, b, _, c, d in entries if a == lst and b == rule and d <= at})
                if past and past[-1][1]:
                    active.append((len(rule), lst == "L", rule))
        top = max(active, default=None)
        return host, len(active), "none" if top is None else "block" if top[1] else "allow", top and top[2]

    want = collections.Counter((i, u, at, *brute(u, at)) for i, u, at in captures)
    assert collections.Counter((r["page_id"], r["url"], r["fetched"], r["host"], r["n_active"], r["verdict"], r["rule"]) for r in got.collect()) == want
    assert url_verdicts(spark.createDataFrame([], "page_id long, url string, fetched date"), e).count() == 0
    assert url_verdicts(spark.createDataFrame(captures, "page_id long, url string, fetched date"), e.limit(0)).filter("verdict <> 'none'").count() == 0
    assert list_intervals(e).filter("valid_to <= valid_from").count() == 0


def test_all_segmentations_are_summed():
    pieces = Pieces(VOCABULARY)
    rng = np.random.default_rng(1)
    p = rng.random((len(pieces.tokens), 2))
    index = {t: i for i, t in enumerate(pieces.tokens)}

    def brute(word):
        if not word:
            return np.ones(2)
        return sum((p[index[word[:k]]] * brute(word[k:]) for k in range(1, len(word) + 1) if word[:k] in index), np.zeros(2))

    words = [b" the", b" a", b" stra\xc3\x9fe", b" other", b" ing", b" houseandhome"]
    assert np.allclose(pieces.log_probability(words, p), np.log([brute(w) for w in words]))
    total = pieces.expected(words, np.ones(len(words)), p[:, 0])
    assert (total * [len(t) for t in pieces.tokens]).sum() == pytest.approx(sum(map(len, words)))


def brute_forward(index, logp, word):
    """Log of the sum over all segmentations, place by place."""
    ahead = [0.0] + [-np.inf] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(max(0, e - 40), e):
            if word[s:e] in index:
                ahead[e] = np.logaddexp(ahead[e], ahead[s] + logp[index[word[s:e]]])
    return ahead


def test_long_words_are_summed_whole():
    pieces = Pieces(VOCABULARY)
    index = {t: i for i, t in enumerate(pieces.tokens)}
    assert pieces.longest <= 40
    p = np.random.default_rng(2).random((len(pieces.tokens), 2)) * 1e-6
    words = [(" " + w).encode() for w in ("достопримечательность", "donaudampfschifffahrtsgesellschaft", "x" * 700, "日本語のとても長い文章" * 9, "an", "antidisestablishmentarianism")]
    want = [[brute_forward(index, np.log(p[:, k]), w)[-1] for k in range(2)] for w in words]
    assert np.allclose(pieces.log_probability(words, p), want)
    for w in words:
        logp, ahead = np.log(p[:, 0]), brute_forward(index, np.log(p[:, 0]), w)
        back = [-np.inf] * len(w) + [0.0]
        for s in range(len(w) - 1, -1, -1):
            for e in range(s + 1, min(len(w), s + 40) + 1):
                if w[s:e] in index:
                    back[s] = np.logaddexp(back[s], back[e] + logp[index[w[s:e]]])
        expected = np.zeros(len(index))
        for s in range(len(w)):
            for e in range(s + 1, min(len(w), s + 40) + 1):
                if w[s:e] in index:
                    expected[index[w[s:e]]] += 3 * np.exp(ahead[s] + logp[index[w[s:e]]] + back[e] - ahead[-1])
        assert np.allclose(pieces.expected([w], np.array([3.0]), p[:, 0]), expected)


def test_languages_against_brute_force(spark):
    """Learning and prediction in plain Python give the same languages and scores."""
    import regex

    rows = [(1, "the other one's here, 12 't", "en"), (2, "The and that. the", "en"), (3, "der und die nicht", "de"), (4, "Über die Straße", "de"), (5, "и другие слова", "ru"), (6, "'s", None), (7, "der the", None), (8, "?", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = Pieces(VOCABULARY)
    index = {t: i for i, t in enumerate(pieces.tokens)}
    cut = lambda t: [(" " + w).encode() for w in regex.findall(r"\p{L}+", t.lower())]
    langs, models = sorted({r[2] for r in rows if r[2]}), {}
    for lang in langs:
        words = [w for _, t, k in rows if k == lang for w in cut(t)]
        n = np.full(len(index), 0.1)
        for w in words:
            for s in range(len(w)):
                for e in range(s + 1, len(w) + 1):
                    if w[s:e] in index:
                        n[index[w[s:e]]] += 1
        p, n = n / n.sum(), np.full(len(index), 0.1)
        for w in words:
            n += pieces.expected([w], np.ones(1), p)
        models[lang] = n / n.sum()
    names, p = learn_languages(df, VOCABULARY)
    assert names == langs and np.allclose(p, np.stack([models[k] for k in langs], 1))
    for r in predict_languages(df, VOCABULARY, names, p).collect():
        words = cut(dict((i, t) for i, t, _ in rows)[r["doc_id"]])
        if not words:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        logs = np.array([sum(brute_forward(index, np.log(models[k]), w)[-1] for w in words) for k in langs])
        share = np.exp(logs - logs.max())
        assert r["lang_pred"] == langs[int(logs.argmax())] and r["score"] == pytest.approx(1 / share.sum())


def test_languages(spark):
    rng = random.Random(6)
    vocabularies = {"en": "the and other that with from reading houses".split(), "de": "der und straße nicht über schön häuser".split(), "fr": "le été où français être maisons lire".split()}
    rows = [(i, " ".join(rng.choices(v, k=rng.randint(3, 40))), k) for i, (k, v) in enumerate(sorted(vocabularies.items()) * 60)]
    odd = [(900, None, "en"), (901, "", "en"), (902, "12 34 ½ !?", "de"), (903, "日本語 text", None), (904, "the " * 5000 + "x" * 500, "en"), (905, "и ещё", "fr"), (None, "the other", "en")]
    df = spark.createDataFrame([(*r, "s", 0.5) for r in [*rows, *odd, rows[0]]], "doc_id long, text string, lang string, lang_pred string, score double")
    names, p = learn_languages(df.filter(~held_out()), VOCABULARY)
    assert names == ["de", "en", "fr"] and np.allclose(p.sum(0), 1)
    got = collections.defaultdict(list)
    for r in predict_languages(df, VOCABULARY, names, p).collect():
        got[r["doc_id"]].append((r["lang_pred"], r["score"]))
    assert sum(map(len, got.values())) == len(rows) + len(odd) + 1
    out = [i for i, _, _ in rows if df is not None and __import__("zlib").crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i][0][0] == dict((r[0], r[2]) for r in rows)[i] for i in out) >= 0.95 * len(out)
    assert [got[i][0] for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[904][0][0] == "en" and got[None][0][0] == "en" and got[905][0][0] in names
    assert predict_languages(df.limit(0), VOCABULARY, names, p).count() == 0
    none, q = learn_languages(df.filter("lang = 'xx'"), VOCABULARY)
    assert {r["lang_pred"] for r in predict_languages(df, VOCABULARY, none, q).collect()} == {"und"}
    small, _ = learn_languages(df, VOCABULARY, sample_rows=5)
    assert small == names


def brute_quality(text):
    """The line rules in plain Python: the text without failing lines, None if it is rejected."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    w = word.findall(text)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    cover = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    if len(w) < 50 or 100 * len(cover) > 50 * len(w):
        return None
    seen, kept, lost = set(), [], 0
    for line in text.split("\n"):
        x = word.findall(line)
        if not x:
            kept.append(line)
            continue
        n, low = len(x), line.lower()
        size = n + len(re.findall("[\u0e00-\u0fff\u1000-\u107f\u1780-\u17ff\u3000-\u9fff\uf900-\ufaff\uff00-\uffff\U00020000-\U0002ffff]", line)) // 2
        held = lambda phrases: [p for p in phrases if re.search(r"(?<![0-9a-z\x80-\U0010ffff])" + p + r"(?![0-9a-z\x80-\U0010ffff])", low)]  # noqa: E731, B023
        fails = line in seen or (size < 10 and (x[-1][-1] not in TERMINAL or x[-1].endswith(("…", "..."))))
        fails |= len(re.findall(r"[#*$%&|<>]", line)) > 0.25 * size or line.count("|") > 0.15 * size or line.count("!") > 0.5 * size
        fails |= size < 20 and bool(held(BOILERPLATE))
        menu = sum(len(p.split()) for p in held(NAVIGATION))
        fails |= menu > 0 and 2 * menu >= n
        letters = re.findall("[A-Za-z]", line)
        fails |= len(letters) >= 10 and sum(c < "a" for c in letters) > 0.6 * len(letters) and size < 20
        fails |= sum(bool(re.search("[0-9]", w)) and not re.search("[A-Za-z\x80-\U0010ffff]", w) for w in x) > 0.5 * n
        fails |= sum(a == b for a, b in zip(x, x[1:])) > 0.3 * size
        seen.add(line)
        lost += n * fails
        if not fails:
            kept.append(line)
    return "\n".join(kept) if lost <= 0.5 * len(w) else None


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from kinoframe.llm.mixing import mix_schedule

    from .test_documents import brute_links, brute_spans, make_docs, words

    rows = [r for r in make_docs() if r[0] is not None and r[4] != 1]
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    pairs = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    first = sorted((i, brute_quality(t)) for i, t, *_ in rows if t and brute_quality(t) is not None)
    assert pairs(out[0]) == first and first
    groups = brute_links(first)
    second = [(i, t) for i, t in first if groups[i][0] == i]
    assert pairs(out[1]) == second and len(second) < len(first)
    third = sorted((i, t if not g else k) for (i, t), (_, n, g, k) in zip(second, brute_spans(second), strict=True) if n > g)
    assert pairs(out[2]) == third
    taken = collections.Counter()
    for r in mix_schedule(out[2]).filter("taken > 0").collect():  # rows that share an id count each for themselves
        taken[r["doc_id"]] += r["taken"]
    got = collections.Counter()
    for i, t in pairs(out[3]):
        got[i] += len(words(t))
        assert " ".join(words(dict(third)[i])).startswith(" ".join(words(t)))
    assert got == taken
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, library.encode(t, add_special_tokens=False).ids) for i, t in pairs(out[3]))
    assert sorted((r["doc_id"], r["ids"]) for r in out[4].collect()) == want


def test_pipeline_of_empty_and_null_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    line = lambda: " ".join("w%d" % rng.randrange(10**6) for _ in range(30)) + "."
    text = "\n".join(line() for _ in range(3))
    rows = [(None, text, "en", "a", 1), (None, line() * 1 + "\n" + line(), None, None, None), (1, text, "en", None, 1), (2, None, None, None, None), (3, "", "en", "a", 0), (1, line() + "\n" + line(), "en", "a", 2)]
    for name, some in (("empty", []), ("odd", rows)):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
        for stage, run in corpus_pipeline.STAGES:
            run(spark, docs, "").write.parquet(f"{tmp_path}/{name}-{stage}")
            docs = spark.read.parquet(f"{tmp_path}/{name}-{stage}")
        ids = {r["doc_id"] for r in docs.collect()}
        assert ids == (set() if name == "empty" else {None, 1})


def test_pipeline_leaves_its_result_only(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "shared_dir", lambda _: str(tmp_path))
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert [p.name.split("-", 1)[1] for p in tmp_path.glob("pipeline-*/*")] == ["bpe_encoding"]
