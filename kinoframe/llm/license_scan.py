"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a paragraph: lines up to one without a word. A template is the set of a notice's
words. A block matches when a window in it, of at most ``SPAN`` times the template's words,
holds at least ``threshold`` of them. Every match counts in n_matches and score; where notices of
one family match the same block, its words tell which labels it gets (the license's own name
and version), and if they tell none, it gets those of the largest containment.

One scan cuts all texts into words and keeps, of each document, the words that are in any
template; the others can't be common. Words are ordered by how many documents hold them,
rarest first. A match needs ``need`` common words, so one of the template's rarest
``size - need + 1`` is there (prefix filter), there are ``need`` template words at all
(length filter), and after the first common word enough are left on both sides (positional
filter). Documents that pass with a template are cut into blocks, and windows round the
places of the template's rarest words are counted in full.

Phrases are found beside that, word by word, at every place of the text.

Defined results: a null or empty text has no words and no labels; rows that share an
id get the labels of any of them, the other columns each from its own text; a null
id is an id; without templates only phrases give labels. Further columns are not kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

#: Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Labels and notices.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Further notices, of licenses that differ from the above in a word or two.
NEIGHBOURS = (
    ("agpl-3.0", "this work is licensed under the gnu affero general public license version 3"),
    ("apache-1.1", "licensed under the apache license version 1 1"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc-nd-4.0", "licensed under cc by nc nd 4 0"),
    ("cc-by-nc-nd-4.0", "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"),
    ("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-sa-4.0", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0"),
    ("cc-by-nd-4.0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2"),
    ("lgpl-2.1", "this work is licensed under the gnu lesser general public license version 2 1"),
    ("lgpl-3.0", "this work is licensed under the gnu lesser general public license version 3"),
    ("mpl-1.1", "this source code form is subject to the terms of the mozilla public license v 1 1"),
)
#: Notices as the licenses' texts or headers give them, up to a sentence or paragraph.
HEADERS = (
    ("boost-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use reproduce display distribute execute and transmit the software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc0-1.0", "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0"),
    ("gpl-2.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl-2.1-or-later", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
)
_CC = r" (?:by|attribution){} (?:(?:international|public|license|version|v) )*4 0 "
#: Licenses that share a family's wording, so that a block may match the notices of several.
FAMILIES = {"gnu": ("agpl", "gpl", "lgpl"), "permission": ("boost", "isc", "mit", "zlib")}
#: What a block's words, joined by spaces, hold if they tell this label from the others of its family.
TELLING = {
    "boost-1.0": r" any person or organization obtaining ",
    "cc0-1.0": r" cc0 ",
    "epl-2.0": r" eclipse public license (?:v |version )?2 0 ",
    "gpl-2.0-or-later": r" gnu general public license as published .*either version 2 of ",
    "gpl-3.0-or-later": r" gnu general public license as published .*either version 3 of ",
    "lgpl-2.1-or-later": r" gnu lesser general public license as published .*either version 2 1 of ",
    "mit": r" (?:mit license|person obtaining a copy of this software|merge publish distribute sublicense) ",
    "zlib": r" granted to anyone to use ",
    "agpl-3.0": r" affero general public license (?:v|version) 3 ",
    "apache-1.1": r" apache (?:software )?license (?:v|version) 1 1 ",
    "apache-2.0": r" apache (?:software )?license (?:v |version )?2 ",
    "cc-by-4.0": _CC.format(""),
    "cc-by-nc-4.0": _CC.format(" (?:nc|noncommercial)"),
    "cc-by-nc-nd-4.0": _CC.format(" (?:nc|noncommercial) (?:nd|noderivatives|noderivs)"),
    "cc-by-nc-sa-4.0": _CC.format(" (?:nc|noncommercial) (?:sa|sharealike)"),
    "cc-by-nd-4.0": _CC.format(" (?:nd|noderivatives|noderivs)"),
    "cc-by-sa-4.0": _CC.format(" (?:sa|sharealike)"),
    "gpl-2.0": r" gnu general public license (?:v|version) 2 ",
    "gpl-3.0": r" gnu general public license (?:v|version) 3 ",
    "lgpl-2.1": r" lesser general public license (?:v|version) 2 1 ",
    "lgpl-3.0": r" lesser general public license (?:v|version) 3 ",
    "mpl-1.1": r" mozilla public license (?:v|version) 1 1 ",
    "mpl-2.0": r" mozilla public license (?:v|version) 2 0 ",
}
ALL_TEMPLATES = TEMPLATES + NEIGHBOURS + HEADERS
#: A match's words lie within so many times the template's number of words.
SPAN = 3
#: All of ASCII but digits and lower-case letters; applied to lower-case text.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Between blocks: an end of line, and a line without a word.
NO_LINE = r"\n[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]*\n"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def family(label: str) -> str:
    """The licenses with which a label can be confused: its first part, or the family of that."""
    first = label.split("-")[0]
    return next((name for name, members in FAMILIES.items() if first in members), first)


def _lower(text: Column) -> Column:
    """A-Z in lower case, all other characters unchanged."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, NO_WORD), "")


def _need(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def _sets(templates: tuple[tuple[str, str], ...], threshold: float) -> list[tuple[int, str, list[str], int]]:
    """(number, label, words, need) of each template."""
    words = [(label, sorted(set(notice.split()))) for label, notice in templates]
    return [(i, label, w, _need(len(w), threshold)) for i, (label, w) in enumerate(words)]


def _held(words: Column, sets: list) -> Column:
    """The words that are in any template."""
    known = sorted({w for _, _, words_, _ in sets for w in words_})
    return F.array_intersect(F.array(*map(F.lit, known)).cast("array<string>"), words)


def _candidates(tokens: DataFrame, sets: list) -> tuple[DataFrame, dict[int, list[str]]]:
    """(doc_id, templates) of documents that pass the filters with a template, and each template's prefix."""
    spark = tokens.sparkSession
    # One row for each word of the templates.
    counts = {r["word"]: r["n"] for r in tokens.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    rarest = lambda w: (counts.get(w, 0), w)
    rows, prefix = [], {}
    for i, _, words, need in sets:
        ordered = sorted(words, key=rarest)
        prefix[i] = ordered[: len(words) - need + 1]
        rows += [(w, i, place, len(words), need) for place, w in enumerate(prefix[i], 1)]
    order = F.array(*map(F.lit, sorted({w for _, _, words, _ in sets for w in words}, key=rarest)))
    prefixes = spark.createDataFrame(rows, "word string, template int, place int, size int, need int")
    here = F.array_position("ordered", F.col("word"))
    left = F.least(F.col("size") - F.col("place"), F.size("ordered") - here)
    passed = (
        tokens.filter(F.size("held") >= min(need for *_, need in sets))
        .select("doc_id", F.array_intersect(order, F.col("held")).alias("ordered"))
        .select("*", F.explode("ordered").alias("word"))
        .join(F.broadcast(prefixes), "word")  # a few rows for each template
        .filter((F.size("ordered") >= F.col("need")) & (left + 1 >= F.col("need")))
    )
    return passed.groupBy("doc_id").agg(F.collect_set("template").alias("templates")), prefix


def _verified(docs: DataFrame, candidates: DataFrame, sets: list, prefix: dict[int, list[str]]) -> DataFrame:
    """(doc_id, at, block, stay, most, matches) of the blocks of ``docs`` (doc_id, lower-case text) that match, by family.

    ``matches`` notices are at the threshold, ``most`` is the largest containment, and ``stay`` are those whose
    label the block tells from the family's others; if it tells none, those it contains most of.
    """
    rows = [(i, label, family(label), words, prefix[i], need, TELLING.get(label, "")) for i, label, words, need in sets]
    notices = docs.sparkSession.createDataFrame(rows, "template int, label string, family string, notice array<string>, prefix array<string>, need int, telling string")
    words, size = F.col("words"), F.size("words")
    span = SPAN * F.size("notice")
    places = F.filter(F.sequence(F.lit(1), size), lambda i: F.array_contains("prefix", F.element_at(words, i)))
    near = F.transform(places, lambda q: F.filter(F.sequence(F.greatest(F.lit(1), q - span + 1), q), lambda i: F.array_contains("notice", F.element_at(words, i))))
    starts = F.when(size <= span, F.array(F.lit(1))).otherwise(F.array_distinct(F.flatten(near)))
    common = lambda w: F.size(F.array_intersect("notice", w))
    windows = F.transform(starts, lambda i: F.slice(words, i, span))
    enough = F.filter(windows, lambda w: common(w) >= F.col("need"))
    tells = lambda w: F.regexp_like(F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" ")), F.col("telling"))
    own = docs.join(candidates.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
    found = (
        own.select("doc_id", "templates", F.posexplode(F.split("text", NO_LINE)).alias("at", "block"))
        .withColumn("words", _words(F.col("block")))
        .withColumn("held", _held(words, sets))
        .select("*", F.explode("templates").alias("template")).drop("templates")
        .join(F.broadcast(notices), "template")  # a row for each template
        .filter(F.size(F.array_intersect("notice", "held")) >= F.col("need"))
        .withColumn("enough", enough)
        .filter(F.size("enough") > 0)
        .select("doc_id", "at", "family", "block", F.struct((F.array_max(F.transform("enough", common)) / F.size("notice")).alias("containment"), F.exists("enough", tells).alias("told"), "label").alias("match"))
        # One array holds the templates of a family at most.
        .groupBy("doc_id", "at", "family").agg(F.first("block").alias("block"), F.collect_list("match").alias("all"))
    )
    told, most = F.filter("all", lambda m: m["told"]), F.array_max(F.transform("all", lambda m: m["containment"]))
    stay = F.when(F.size(told) > 0, told).otherwise(F.filter("all", lambda m: m["containment"] == most))
    return found.select("doc_id", "at", "block", stay.alias("stay"), most.alias("most"), F.size("all").alias("matches"))


def matching_blocks(docs: DataFrame, templates: tuple[tuple[str, str], ...] = ALL_TEMPLATES, threshold: float = 0.85, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, at, block, label, containment) of every block and template that match: the block's
    number in its text, and its text in lower case.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), _lower(F.col(text)).alias("text"))
    sets = _sets(templates, threshold)
    tokens = written(docs.select("doc_id", _held(_words(F.col("text")), sets).alias("held")), "license-words")
    candidates, prefix = _candidates(tokens, sets)
    found = _verified(docs, candidates, sets, prefix).select("doc_id", "at", "block", F.explode("stay").alias("match"))
    return found.groupBy("doc_id", "at", F.col("match.label").alias("label")).agg(F.first("block").alias("block"), F.max("match.containment").alias("containment"))


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = ALL_TEMPLATES, threshold: float = 0.85, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_words, the places of phrases (n_base, first_word,
    last_word, base_labels), labels of phrases and templates, score, the largest containment, and
    n_matches, the blocks and notices that meet the threshold.
    """
    sets = _sets(templates, threshold)
    lower = docs.select(F.col(id_col).alias("doc_id"), _lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    words = lower.select("doc_id", _words(F.col("text")).alias("words"))
    at = None
    may = F.lit(False)
    for phrase, label in PHRASES:
        first, *rest = phrase.split()

        def starts(w: Column, i: Column, first=first, rest=rest) -> Column:
            hit = w == first
            for k, x in enumerate(rest, 1):
                hit = hit & (F.get(F.col("words"), i + k) == x)
            return hit

        may = may | (F.array_contains("words", rest[-1]) & F.array_contains("words", first))
        was = at
        at = lambda w, i, was=was, starts=starts, label=label: F.when(starts(w, i), F.lit(label)).otherwise(was(w, i) if was else F.lit(None))
    marked = F.filter(F.transform("words", lambda w, i: F.struct(i.cast("long").alias("at"), at(w, i).alias("label"))), lambda s: s["label"].isNotNull())
    none = F.array().cast("array<struct<at: bigint, label: string>>")
    base = words.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(may, marked).otherwise(none).alias("hits"), _held(F.col("words"), sets).alias("held"))
    places, names = F.transform("hits", lambda s: s["at"]), F.array_distinct(F.transform("hits", lambda s: s["label"]))
    base = base.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_sort(names).alias("_base"), "held",
    )
    base = written(base, "license-words")
    if sets:
        candidates, prefix = _candidates(base, sets)
        found = _verified(lower, written(candidates, "license-candidates"), sets, prefix)
        found = found.groupBy(F.col("doc_id").alias("_id")).agg(
            # A document's matches, of which there are few beside its blocks.
            F.array_distinct(F.flatten(F.collect_set(F.transform("stay", lambda m: m["label"])))).alias("_labels"), F.max("most").alias("_score"), F.sum("matches").alias("_matches"),
        )
        base = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    else:
        base = base.withColumns({"_labels": F.lit(None).cast("array<string>"), "_score": F.lit(None).cast("double"), "_matches": F.lit(None).cast("long")})
    labels = F.array_sort(F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_score", F.lit(0.0)))
    return base.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
        F.coalesce("_matches", F.lit(0)).cast("long").alias("n_matches"),
    )
