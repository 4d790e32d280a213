"""Captioners and aggregators by name: functions of a text, and folds of a group's texts in two parts.

An aggregator folds rows to a state, merges states, and makes a result of one. Tasks fold their
own rows first and give out a state for each group they hold; states are then merged, in two steps,
as they stream by. So no group's rows ever come together, and a group of any size takes the
memory of a state. A state must not depend on the order in which rows and states come.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import STOP_WORDS

#: Groups whose states a task holds before it gives them out; first step's parts of a group.
HELD, PARTS = 4096, 256


class Aggregator:
    """A fold of rows (order, text): ``state`` and ``result`` are DDL, a state a dict of the former."""

    state = ""
    result = ""

    def __init__(self, **options: Any):
        self.options = options

    def fold(self, state: dict | None, order: Any, text: str | None) -> dict:
        """The state with one more row; None before the first."""
        raise NotImplementedError

    def merge(self, one: dict, other: dict) -> dict:
        raise NotImplementedError

    def finish(self, state: dict) -> dict:
        raise NotImplementedError


class Summary(Aggregator):
    """The first caption after a lead, and how many there are; rows without text aren't captions."""

    state = "at long, text string, n long"
    result = "description string"

    def __init__(self, lead: str = "Scene:"):
        self.lead = lead

    def fold(self, state: dict | None, order: Any, text: str | None) -> dict:
        return self.merge(state or {"at": None, "text": None, "n": 0}, {"at": order, "text": text, "n": int(text is not None)})

    def merge(self, one: dict, other: dict) -> dict:
        n = one["n"] + other["n"]
        # Of equal orders the smaller text is first; a missing order is last.
        first = min((s for s in (one, other) if s["n"]), key=lambda s: (s["at"] is None, s["at"] or 0, s["text"]), default=one)
        return {"at": first["at"], "text": first["text"], "n": n}

    def finish(self, state: dict) -> dict:
        return {"description": f"{self.lead} {state['text'] if state['n'] else 'empty'} ({state['n']} frames observed.)"}


class Tags(Aggregator):
    """The most frequent words of more than two letters, stop words aside; of equals the one seen first.

    The state has a row for each different word.
    """

    state = "words map<string,struct<n: long, at: long, place: int>>"
    result = "tags array<string>"
    word = re.compile("[a-z]+")

    def __init__(self, n: int = 5):
        self.n = n

    def fold(self, state: dict | None, order: Any, text: str | None) -> dict:
        words = state["words"] if state else {}
        for place, w in enumerate(self.word.findall((text or "").lower())):
            if len(w) > 2 and w not in STOP_WORDS:
                self._count(words, w, {"n": 1, "at": order, "place": place})
        return {"words": words}

    @staticmethod
    def _count(words: dict, w: str, new: dict) -> None:
        old = words.get(w)
        if old is None:
            words[w] = dict(new)
            return
        old["n"] += new["n"]
        if (new["at"], new["place"]) < (old["at"], old["place"]):
            old["at"], old["place"] = new["at"], new["place"]

    def merge(self, one: dict, other: dict) -> dict:
        for w, new in dict(other["words"]).items():
            self._count(one["words"], w, new)
        return one

    def finish(self, state: dict) -> dict:
        ranked = sorted(dict(state["words"]).items(), key=lambda x: (-x[1]["n"], x[1]["at"], x[1]["place"]))
        return {"tags": [w for w, _ in ranked[: self.n]]}


AGGREGATORS: dict[str, type[Aggregator]] = {"summary": Summary, "tags": Tags}


def first_sentence(text: str) -> str:
    """Up to the first full stop, question or exclamation mark."""
    return re.split(r"(?<=[.!?])\s", text.strip(), maxsplit=1)[0]


def plain(text: str) -> str:
    """Words only, in lower case."""
    return " ".join(re.findall("[a-z]+", text.lower()))


#: Functions of one text by name.
CAPTIONERS: dict[str, Callable[[str], str | None]] = {"first_sentence": first_sentence, "plain": plain}


def _named(registry: dict[str, Any], name: str, what: str) -> Any:
    if name.lower() not in registry:
        raise ValueError(f"no {what} {name}; there are {', '.join(sorted(registry))}")
    return registry[name.lower()]


def captioned(text: Column, name: str, registry: dict[str, Callable[[str], str | None]] | None = None) -> Column:
    """The captioner's text of each text, in Arrow batches; null for null."""
    function = _named(CAPTIONERS | (registry or {}), name, "captioner")

    @F.arrow_udf("string")
    def caption(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else function(t) for t in texts.to_pylist()], pa.string())

    return caption(text)


def aggregated(df: DataFrame, by: list[str], order: str, text: str, name: str, registry: dict[str, type[Aggregator]] | None = None, **options: Any) -> DataFrame:
    """(by, result): the named aggregator over the texts of each group; groups by nulls, too."""
    worker = _named(AGGREGATORS | (registry or {}), name, "aggregator")(**options)
    keys = [df.schema[k] for k in by]
    partial = T.StructType([*keys, T.StructField("state", T._parse_datatype_string(worker.state))])
    final = T.StructType([*keys, *T._parse_datatype_string(worker.result).fields])
    partial_arrow, final_arrow = to_arrow_schema(partial), to_arrow_schema(final)

    def rows_of(states: dict[tuple, dict]) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in states], f.type) for i, f in enumerate(list(partial_arrow)[:-1])]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(states.values()), partial_arrow.field("state").type)], schema=partial_arrow)

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, dict] = {}
        for batch in batches:
            *names, orders, texts = (c.to_pylist() for c in batch.columns)
            for key, at, t in zip(zip(*names, strict=True), orders, texts, strict=True):
                states[key] = worker.fold(states.get(key), at, t)
                if len(states) > HELD:
                    yield rows_of(states)
                    states = {}
        if states:
            yield rows_of(states)

    def plain_state(value: Any) -> dict:
        return {k: dict(v) if isinstance(v, list) else v for k, v in value.as_py().items()}

    def merged(states: Iterator[pa.RecordBatch]) -> tuple[list, dict]:
        whole, key = None, None
        for batch in states:
            for i in range(batch.num_rows):
                one = plain_state(batch.column("state")[i])
                if whole is None:
                    key, whole = [batch.column(k)[i].as_py() for k in by], one
                else:
                    whole = worker.merge(whole, one)
        return key, whole

    def some(states: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole = merged(states)
        yield rows_of({tuple(key): whole})

    def last(states: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole = merged(states)
        got = worker.finish(whole)
        values = [*key, *(got[f.name] for f in list(final_arrow)[len(by) :])]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, final_arrow, strict=True)], schema=final_arrow)

    for step in (some, last):
        step.__annotations__ = {"states": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    states = df.select(*by, order, text).mapInArrow(fold, partial)
    states = states.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    states = states.groupBy(*by, "_part").applyInArrow(some, partial)
    return states.groupBy(*by).applyInArrow(last, final)
