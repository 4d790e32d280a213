"""Operators on documents against brute force, on ordinary and on odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinoframe.llm import queries
from kinoframe.llm.bpe import ByteBpe, decode_bpe, encode_bpe
from kinoframe.llm.license_scan import matching_blocks, scan_licenses
from kinoframe.llm.mixing import mix, mix_schedule
from kinoframe.llm.ngram_join import bands_for, near_duplicates
from kinoframe.llm.quality import line_first_quality
from kinoframe.llm.substring_dedup import remove_duplicate_spans
from kinoframe.llm.token_store import Coder, frequency_table, read_span, read_store, store_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, tag string, spans string, row string, size string, words string, copy string"


def words(text):
    return WORD.findall(text or "")


def make_docs():
    rng = random.Random(5)
    vocabulary = ["the", "of", "a", "in", "été", "straße", "niño"] + ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choices(vocabulary, k=n)).capitalize() + "."
    text = lambda lines, n: "\n".join(sentence(n) for _ in range(lines))
    passage = sentence(60)
    rows = [text(4, 30) for _ in range(30)]
    rows += [rows[0], rows[1], rows[1], rows[2].replace("the", "The", 2) + " end.", rows[3] + "\n" + sentence(8)]
    rows += [text(2, 20) + "\n" + passage + "\n" + text(1, 20) for _ in range(6)]
    rows += [None, "", "  \n\t ", "word", "one two three four", "cc by cc by", "All rights\nreserved", "x" * 5000, " ".join(["Der"] * 300), sentence(40) * 80]
    rows += ["CC-BY 4.0, GNU General Public License; all rights reserved", "Licensed under the Apache License, Version 2.0.", "a<|endoftext|>b  c d 日本語 é ﬁ 😀 '’s we'll\x1c x"]
    rows += ["\n".join(["Home | About | Contact"] * 40) + "\n" + text(1, 10), "\n".join(["Same line here again."] * 30)]
    out = [(i, t, "en", f"src{i % 4}" if i % 7 else None, len(t or ""), 7, "x", "t", "s", "r", "z", "w", "c") for i, t in enumerate(rows)]
    return [*out, out[5], out[6], (None, rows[4], "en", "src1", 1, 7, "x", "t", "s", "r", "z", "w", "c"), (3, rows[8], "en", "src2", 1, 7, "x", "t", "s", "r", "z", "w", "c")]


@pytest.fixture(scope="module")
def rows():
    return make_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_counts(docs, rows, empty):
    got = {(r["doc_id"], r["n_chars"]): r for r in line_first_quality(docs.drop("kept", "n_words")).collect()}
    for i, t, _, _, n, *_ in rows:
        if i is None or n == 1:
            continue
        w = words(t)
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        cover = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        r = got[i, n]
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover), failed,
        )
        assert not (failed and r["kept"])
    assert line_first_quality(docs).columns.count("kept") == 1
    assert line_first_quality(empty).count() == 0


def test_quality_removes_lines_and_keeps_clean_documents(spark):
    rng = random.Random(9)
    clean = "\n".join(" ".join("w%d" % rng.randrange(10**6) for _ in range(14)) + "." for _ in range(6))
    nav = "Home | About | News | Contact | Login"
    texts = [clean, clean + "\n" + nav, nav + "\n" + nav + "\n" + clean + "\nAll rights reserved.", "\n".join([nav + " %d" % k for k in range(20)])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_first_quality(df, cleaned=True).collect()}
    assert [got[i]["kept"] for i in range(4)] == [True, True, True, False]
    assert [got[i]["clean_text"] for i in range(3)] == [clean] * 3
    assert got[2]["n_lost_words"] == 9 + 9 + 3


def line_verdicts(spark, lines):
    """Which lines go, each in a document of twelve others that stay."""
    rng = random.Random(11)
    filler = "\n".join(" ".join("w%d" % rng.randrange(10**6) for _ in range(14)) + "." for _ in range(12))
    got = line_first_quality(spark.createDataFrame([(i, filler + "\n" + x) for i, x in enumerate(lines)], "doc_id long, text string"), cleaned=True)
    return {lines[r["doc_id"]]: r["clean_text"] == filler for r in got.collect()}


def test_quality_of_single_lines(spark):
    stay = [
        "The design in question is an elegant one for its age.", "She found the dialog in the third act wanting.", "Он вчера это сделал и пошёл домой, а потом мы долго говорили.",
        "Он вчера это делает.", "彼は昨日その仕事を終えて、家に帰った。", "これは長い日本語の文章で句読点がないまま続いていくものです", "He asked why she baked one cookie only.", "Она ушла…\u201d",
        "You have to sign in at the desk before you may enter.", "เขาไปทำงานเมื่อวานนี้แล้วกลับบ้านตอนเย็นกับเพื่อนของเขา", "Why not?", "Was ist das！",
    ]
    go = [
        "Home | About | News", "All rights reserved.", "Sign in to continue.", "Click here to read more!", "Он вчера это сделал", "en bæ", "Read the rest...", "日本語", "This site uses cookies to improve what you see.",
        "BUY THIS GREAT THING NOW OR NEVER.", "123 456 789 1011 1213 1415 1617 1819 2021 2223.", "the the the the the the the the the the the the.", "#a #b #c #d #e #f #g #h #i #j #k.", "wow!! wow!! yes!! wow!!",
    ]
    got = line_verdicts(spark, stay + go)
    assert [x for x in stay if got[x]] == [] and [x for x in go if not got[x]] == []


def brute_spans(rows, n=13):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            if i is not None and (g not in first or i < first[g]):
                first[g] = i
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k : k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_substring_dedup(docs, rows, empty):
    want = sorted((str(i), n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute_spans([(r[0], r[1]) for r in rows]))
    for by_content in (True, False):
        got = remove_duplicate_spans(docs, digest=True, by_content=by_content)
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()) == want
    full = remove_duplicate_spans(docs.select("doc_id", "text", "source", "tag", "n_words")).collect()
    assert len(full) == len(rows)
    assert all(r["kept_text"] == r["text"] for r in full if not r["n_removed"])
    assert remove_duplicate_spans(empty, digest=True).count() == 0


def test_substring_dedup_of_a_few_words_in_many_orders(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("ab", weights=[9, 1], k=rng.randint(0, 60)))) for i in range(60)]
    got = remove_duplicate_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in got) == sorted(x[:3] for x in brute_spans(rows))


def test_substring_dedup_of_shared_passages_in_most_documents(spark):
    """A passage in all documents, and rows that share an id: keys that are split among tasks."""
    rng = random.Random(7)
    passage = " ".join("p%d" % rng.randrange(10**6) for _ in range(40))
    rows = [(i // 2 if i < 20 else i, " ".join("w%d" % rng.randrange(50) for _ in range(rng.randrange(30))) + " " + passage + " end") for i in range(400)]
    got = remove_duplicate_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got if r["n_removed"]) == sorted(x for x in brute_spans(rows) if x[2])


def brute_links(rows, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets.setdefault(i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    degree = collections.Counter(x for p in links for x in p)
    return {i: (root[i], degree[i]) for i in ids}


def test_ngram_join(docs, rows, empty):
    got = near_duplicates(docs.filter("n_chars <> 1"))
    want = brute_links([(r[0], r[1]) for r in rows if r[4] != 1])
    assert {r["doc_id"]: (r["group_id"], r["n_links"]) for r in got.collect()} == want
    assert got.filter("kept").select("doc_id").distinct().count() == len({g for g, _ in want.values()})
    odd = near_duplicates(docs.filter("n_chars = 1")).collect()  # a null id and an id of two texts
    assert {r["doc_id"]: r["kept"] for r in odd} == {None: True, 3: True, **{r["doc_id"]: True for r in odd}}
    assert near_duplicates(empty).count() == 0


def test_ngram_join_beside_columns_of_its_own_names(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "other words stand in this one here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("rep", "copies", "band", "bucket", "n", "size", "grams", "bands", "m", "hot", "key1", "group_id", "n_links", "kept", "_salt")
    got = near_duplicates(df.withColumns({c: F.lit("x") for c in names}))
    assert sorted(map(tuple, got.select("doc_id", "group_id", "n_links", "kept").collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 3, 0, True)]


def test_ngram_join_in_large_buckets(spark):
    rng = random.Random(2)
    base = ["w%d" % rng.randint(0, 10**6) for _ in range(60)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(60)] = "x%d" % rng.randint(0, 9)
        rows.append((i, " ".join(w)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["group_id"], r["n_links"]) for r in got.collect()} == brute_links(rows)


def test_bands_meet_the_recall():
    for rows in (3, 5, 8):
        b = bands_for(0.8, 0.999, rows)
        assert 1 - (1 - 0.8**rows) ** b >= 0.999 > 1 - (1 - 0.8**rows) ** (b - 1)


def test_licenses(docs, rows, empty):
    got = {}
    for r in scan_licenses(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    phrases = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
    for i, t, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        hits = [(k, label) for p, label in phrases for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want = (len(w), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None), ",".join(sorted({x for _, x in hits})))
        assert want in [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got[i]]
    apache = next(i for i, t, *_ in rows if t and t.startswith("Licensed under the Apache"))
    assert got[apache][0]["labels"] == "apache-2.0" and got[apache][0]["score"] == 1.0
    assert scan_licenses(empty).count() == 0
    assert scan_licenses(docs, templates=()).count() == len(rows)


def test_matching_blocks_lose_none_to_the_filters(docs, spark):
    rng = random.Random(3)
    pool = "licensed under the apache license version 2 0 mit released cc by nc work gnu".split()
    lines = [" ".join(rng.choices(pool, k=rng.randint(1, 14))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    templates = (("a", "licensed under the apache license version 2 0"), ("b", "released under the mit license"), ("c", "licensed under cc by nc"))
    for threshold in (0.5, 0.7, 1.0):
        got = {(r["doc_id"], r["label"]) for r in matching_blocks(df, templates, threshold).collect()}
        want = {(i, label) for i, t in enumerate(lines) for label, notice in templates if len(set(t.split()) & set(notice.split())) >= threshold * len(set(notice.split())) - 1e-9}
        assert got == want


def test_wrapped_notices(spark):
    texts = [
        ("Copyright Some One\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:", "bsd"),
        (" * This Source Code Form is subject to the terms of the Mozilla Public\r\n * License, v. 2.0. If a copy of the MPL was not distributed", "mpl-2.0"),
        ("# this is free\n# and unencumbered\n# software\n# released into\n# the public\n# domain", "unlicense"),
        ("a\n\nReleased under\nthe MIT\nlicense.\nLicensed under the Apache\nLicense, Version 2.0", "apache-2.0,mit"),
        ("Released under the\n\nMIT license", ""),
        ("", ""),
        (None, ""),
    ]
    got = scan_licenses(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string"))
    assert {r["doc_id"]: r["labels"] for r in got.collect()} == {i: label for i, (_, label) in enumerate(texts)}


def test_licenses_of_very_long_words_and_texts(spark):
    texts = [("x" * 300_000, ""), ("the of a in and " * 20_000 + "Released under the MIT License", "mit"), ("a" * 100_000 + " all rights reserved", "reserved"), ("\n" * 50_000 + "CC BY", "cc-by")]
    got = scan_licenses(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("words", "held", "hits", "label", "templates")}))
    assert {r["doc_id"]: r["labels"] for r in got.collect()} == {i: label for i, (_, label) in enumerate(texts)}


def test_neighbouring_licenses_are_told_apart(spark):
    cc, gnu = "This work is licensed under a Creative Commons", "This work is licensed under the GNU"
    far = " ".join(f"{w} " + "x " * 30 for w in "released under the mit license".split())
    texts = [
        ("Licensed under CC BY 4.0.", {"cc-by-4.0"}),
        ("Licensed under CC BY-SA 4.0.", {"cc-by-sa-4.0"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("Licensed under CC BY-NC-SA 4.0.", {"cc-by-nc-sa-4.0"}),
        ("Licensed under CC BY-SA 4.0.\nLicensed under CC BY-NC 4.0.", {"cc-by-sa-4.0", "cc-by-nc-4.0"}),
        (f"{cc} Attribution 4.0 International License", {"cc-by-4.0"}),
        (f"{cc} Attribution-NonCommercial 4.0 International License", {"cc-by-nc-4.0"}),
        (f"{cc} Attribution-ShareAlike 4.0 International License", {"cc-by-sa-4.0"}),
        (f"{gnu} General Public License, version 2", {"gpl-2.0"}),
        (f"{gnu} General Public License, version 3", {"gpl-3.0"}),
        (f"{gnu} Lesser General Public License, version 3", {"lgpl-3.0"}),
        (f"{far} and so on", set()),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this program", {"mit"}),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software", {"boost-1.0"}),
        (f"{gnu} General Public License, version 9", {"gpl-2.0", "gpl-3.0"}),
        ("x " * 600 + "Released under the MIT License. " + "x " * 600, {"mit"}),
        ("x " * 600 + "Licensed under the Apache License, Version 2.0. " + "x " * 600, {"apache-2.0"}),
    ]
    got = scan_licenses(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string"))
    labels = {r["doc_id"]: set(r["labels"].split(",")) - {"", *r["base_labels"].split(",")} for r in got.collect()}
    assert labels == {i: label for i, (_, label) in enumerate(texts)}


def test_mixing(docs, rows, empty):
    got = mix_schedule(docs).collect()
    assert len(got) == len(rows) and got
    size = collections.Counter()
    for _, t, _, s, *_ in rows:
        size[s] += len(words(t))
    total, order = sum(size.values()), sorted(size, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, rest = {}, set(order), 1.5 * total
    while True:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        rest -= sum(2 * size[s] for s in over)
        free -= over
    by_size = {}
    for r in got:
        by_size.setdefault(r["source_size"], []).append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s in order:
        mine = [r for r in by_size[size[s]]]
        assert mine[0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= max(r["size"] for r in mine)
    assert sum(r["taken"] for r in got) == int(1.5 * total)
    assert sorted(map(str, got)) == sorted(map(str, mix_schedule(docs.repartition(5)).collect()))
    assert mix_schedule(empty).count() == 0


def test_mixture_of_null_ids(spark):
    rows = [(None, "a b c", "s"), (None, "d e f g", "s"), (1, "h", None), (1, None, "s"), (None, "a b c", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(0) for c in ("size", "row", "tag", "finish", "served", "_range")})
    schedule, mixed = mix_schedule(df).collect(), mix(df).collect()
    assert len(schedule) == 5 and sum(r["taken"] for r in schedule) == int(1.5 * 11)
    assert sum(len(words(r["text"])) for r in mixed) == int(1.5 * 11)


def test_mixture_texts(docs):
    taken = {}
    for r in mix_schedule(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    mixed = mix(docs).collect()
    got = collections.Counter()
    for r in mixed:
        got[r["doc_id"]] += len(words(r["text"]))
    assert {k: v for k, v in taken.items() if v} == dict(got)
    assert {"doc_id", "text", "source", "tag"} <= set(mixed[0].asDict())


BYTE, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def test_bpe_is_the_library(docs, rows):
    library = Tokenizer.from_file(BYTE)
    encoded = encode_bpe(docs, BYTE)
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(library.encode(r[1] or "", add_special_tokens=False).ids)
    for r in encoded.collect():
        assert r["ids"] in want[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
    back = sorted((str(r["doc_id"]), r["text"]) for r in decode_bpe(encoded, BYTE).collect())
    assert back == sorted((str(r[0]), r[1] or "") for r in rows)


def test_bpe_of_any_characters():
    rng = random.Random(4)
    library, own = Tokenizer.from_file(BYTE), ByteBpe(BYTE)
    pool = [chr(c) for c in [*range(0x250), 0x2028, 0x3000, 0x1680, 0x4E00, 0x1F600, 0x301, 0x200B]]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(1500)] + ["ab" * 900, "abcdefghi" * 3000, "ж" * 9000, "'s", " 's", "\n's", "a  'll"]
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids
        assert own.decode(ids) == t


def test_token_store(spark, docs, rows, empty, tmp_path):
    library = Tokenizer.from_file(WORDS)
    store_documents(docs, WORDS, f"{tmp_path}/store", end_id=1)
    got = sorted(read_store(spark, f"{tmp_path}/store").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is None, i or 0))
    assert np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist() == [r["start"] for r in got]
    want = sorted((str(r[0]), [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in rows)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    digests = {r["start"]: r["ids_crc32"] for r in read_store(spark, f"{tmp_path}/store", digest=True).collect()}
    assert digests == {r["start"]: zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got}
    flat = [x for r in got for x in r["ids"]]
    for start, n in ((0, 10), (700, 5000), (len(flat) - 3, 100), (0, len(flat))):
        pieces = sorted(read_span(spark, f"{tmp_path}/store", start, n).collect(), key=lambda r: r["at"])
        assert [x for r in pieces for x in r["ids"]] == flat[start : start + n] and pieces[0]["at"] == start
    store_documents(empty, WORDS, f"{tmp_path}/none", end_id=1)
    assert read_store(spark, f"{tmp_path}/none").count() == 0


def test_damaged_blocks_are_found(spark, docs, tmp_path):
    store_documents(docs, WORDS, f"{tmp_path}/a", end_id=1)
    spark.read.parquet(f"{tmp_path}/a/table").write.parquet(f"{tmp_path}/b/table")
    spark.read.parquet(f"{tmp_path}/a/blocks").withColumn("crc32", F.col("crc32") + 1).write.parquet(f"{tmp_path}/b/blocks")
    with pytest.raises(Exception, match="damaged"):
        read_store(spark, f"{tmp_path}/b").count()


@pytest.mark.parametrize("n", [1, 2, 63, 64, 1000, 70_000])
def test_coder_round_trip_and_checkpoints(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(0, 900).astype(np.uint32)
    coder = Coder(frequency_table(np.bincount(ids)))
    stream, marks = coder.encode(ids, 16, 8)
    assert (coder.decode(stream, marks, n, 16, 8) == ids).all()
    parts = [coder.decode(stream, marks, n, 16, 8, part=k) for k in range(len(marks) // (8 + 8 * 16))]
    assert (np.concatenate(parts) == ids).all()


def test_frequency_table_sums_up():
    with pytest.raises(ValueError, match="symbols"):
        frequency_table(np.ones((1 << 18) + 1, np.int64))
    for counts in ([0, 5, 0, 1], [10**12, 1, 1, 1], [1] * 50_000):
        f = frequency_table(np.array(counts))
        assert f.sum() == 1 << 18 and ((f > 0) == (np.array(counts) > 0)).all()


def test_queries_are_numbered():
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES} == set(range(1, 11))


def test_mix_tells_rows_of_one_id_and_text_apart(spark):
    """Two sources hold one id and text: each copy carries the source whose share it is."""
    rows = [(1, "a b c d", "x", {"k": 1}), (1, "a b c d", "y", {"k": 1}), (2, "e f", "x", None), (2, "e f", "x", None), (3, "g", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string,int>")
    taken = collections.Counter()
    for r in mix_schedule(df).collect():
        taken[r["doc_id"], r["size"], r["source_size"]] += r["taken"]
    mixed = collections.Counter()
    size = {"x": 8, "y": 4, None: 1}
    for r in mix(df).collect():
        mixed[r["doc_id"], {1: 4, 2: 2, 3: 1}[r["doc_id"]], size[r["source"]]] += len(r["text"].split())
    assert mixed == +taken


def test_groups_of_very_long_texts_make_many_tiles(spark, monkeypatch):
    """Tiles are bounded by the grams of their members, whatever their number; the links are the same."""
    from kinoframe.llm import ngram_join

    monkeypatch.setattr(ngram_join, "MOST_GRAMS", 4000)
    real = ngram_join._tiles

    def watched(threshold):
        run = real(threshold)

        def watch(table):
            if len(table) > 200_000 // 4000:
                raise AssertionError("a tile of more members than its grams allow")
            return run(table)

        return watch

    monkeypatch.setattr(ngram_join, "_tiles", watched)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(600)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(0, 12)):
            w[rng.randrange(600)] = f"x{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["group_id"], r["n_links"]) for r in got.collect()} == brute_links(rows)


def test_encoders_beside_columns_of_their_own_names_and_on_empty_tables(spark, tmp_path):
    from kinoframe.llm.bpe import bpe_round_trip

    plain = spark.createDataFrame([(1, "all rights"), (2, None), (None, "x")], "doc_id long, text string")
    odd = plain.withColumns({c: F.lit("x") for c in ("ids", "n_tokens", "ids_sha256", "decoded_sha256", "segment", "block", "start", "words", "crc32", "inner", "first")})
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = lambda d, *c: sorted(map(repr, d.select(*c).collect()))
    assert rows(bpe_round_trip(odd, BYTE), *columns) == rows(bpe_round_trip(plain, BYTE), *columns)
    assert rows(encode_bpe(odd, BYTE), "doc_id", "ids", "n_tokens") == rows(encode_bpe(plain, BYTE), "doc_id", "ids", "n_tokens")
    assert bpe_round_trip(plain.limit(0), BYTE).count() == encode_bpe(plain.limit(0), BYTE).count() == 0
    for name, docs_ in (("odd", odd), ("plain", plain)):
        store_documents(docs_, WORDS, f"{tmp_path}/{name}", end_id=1)
    assert rows(read_store(spark, f"{tmp_path}/odd"), "doc_id", "start", "n_tokens", "ids") == rows(read_store(spark, f"{tmp_path}/plain"), "doc_id", "start", "n_tokens", "ids")
