"""Fill-in-middle transformation: whole batches of texts are cut and rearranged by one NumPy kernel.

A text is a sequence of units, runs of ASCII letters or single other code points. Two cuts
between units part it into prefix, middle and suffix, which go out as
``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm); a plain text goes
out as it is. Cuts and form follow from the first four 8-digit groups of the SHA-256 of
``seed:doc_id``, so reruns agree and no row depends on another.

The kernel works on the UTF-8 buffer of an Arrow column: a table gives each byte's class,
neighbouring classes give the mask of unit starts, cumulative sums from each text's start
count units and code points, and one search in them finds the cuts of all rows.
A batch is handled about a megabyte at a time, so its index arrays stay small; a longer text
is one block, of which the pieces are copied and only the sums are as long.

Defined results: a null text is empty and plain; a null doc_id hashes as ``seed:``; a text that
holds a marker is plain, so every output can be restored; repeated rows and extra columns
stay in no other row's way (only doc_id and text are read).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKERS = ("<P>", "<S>", "<M>")
FORMS = np.array(["plain", "psm", "spm"])
#: Bytes of text handled together.
BLOCK = 1 << 20
#: Byte classes: the rest of a code point, a letter, the first byte of any other code point.
INNER, LETTER, OTHER = 0, 1, 2
CLASS = np.full(256, OTHER, np.uint8)
CLASS[0x80:0xC0] = INNER
CLASS[ord("A") : ord("Z") + 1] = CLASS[ord("a") : ord("z") + 1] = LETTER

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column and the row borders in them."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces ``data[start:start + size]`` one after the other."""
    end = np.cumsum(size)
    if not len(end) or end[-1] > BLOCK:
        return np.concatenate([data[s : s + n] for s, n in zip(start.tolist(), size.tolist(), strict=True)] or [data[:0]])
    return data[np.arange(end[-1]) + np.repeat(start - end + size, size)]


def cut(data: np.ndarray, at: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """(units, smaller cut, larger cut, code points before each) of every row of a buffer.

    ``first`` and ``second`` are unsigned draws: a row of n units is cut after draw % (n + 1) units.
    """
    kind = CLASS[data]
    begins = kind == OTHER
    letters = kind == LETTER
    opens = letters.copy()
    opens[1:] &= ~letters[:-1]
    borders = at[:-1][at[:-1] < len(data)]
    opens[borders] = letters[borders]
    begins |= opens
    units, points = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int64)
    np.cumsum(begins, out=units[1:])
    np.cumsum(kind != INNER, out=points[1:])
    base = units[at[:-1]]
    n = units[at[1:]] - base
    a, b = first % (n + 1), second % (n + 1)
    cuts = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        # The byte before which k units are whole: where the next unit starts, or the text's end.
        place = np.searchsorted(units, base + k + 1) - 1
        cuts.append(np.where(k == n, at[1:], place))
    return n, cuts[0], cuts[1], points[cuts[0]] - points[at[:-1]], points[cuts[1]] - points[cuts[0]]


def arranged(texts: pa.Array, draws: np.ndarray, plain_share: int, spm_share: int) -> tuple[np.ndarray, ...]:
    """(units, form, prefix and middle code points, output) of a column of texts, all rows together."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    data, at = _buffers(texts)
    n, low, high, before, between = cut(data, at, draws[:, 0], draws[:, 1])
    plain = (np.diff(at) == 0) | (draws[:, 2] % 100 >= 100 - plain_share)
    for marker in MARKERS:
        plain |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < spm_share, 2, 1))
    # Markers stand behind the texts in the buffer that pieces are gathered from.
    source = np.concatenate([data, np.frombuffer("".join(MARKERS).encode(), np.uint8)])
    p, s, m = (np.full(len(n), len(data) + 3 * k) for k in range(3))
    three = np.full(len(n), 3)
    prefix, middle, suffix = (at[:-1], low - at[:-1]), (low, high - low), (high, at[1:] - high)
    psm = [(p, three), prefix, (s, three), suffix, (m, three), middle]
    spm = [(s, three), suffix, (p, three), prefix, (m, three), middle]
    none = np.zeros(len(n), np.int64)
    whole = [(at[:-1], np.diff(at)), *[(none, none)] * 5]
    start, size = (np.stack([np.choose(form, [w[k], x[k], y[k]]) for w, x, y in zip(whole, psm, spm, strict=True)], 1) for k in (0, 1))
    out = _gathered(source, start.ravel(), size.ravel())
    ends = np.concatenate([[0], np.cumsum(size.sum(1))])
    output = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out))
    return n, form, before, between, output.cast(pa.string())


def _kernel(plain_share: int, spm_share: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(sizes)])
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(sums, sums[lo] + BLOCK, "right")) - 1)
                rows = batch.slice(lo, hi - lo)
                draws = np.stack([rows.column(f"h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4)], 1).astype(np.int64)
                n, form, before, between, output = arranged(rows.column("text"), draws, plain_share, spm_share)
                counts = [pa.array(x, pa.int64(), mask=form == 0) for x in (before, between)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(FORMS[form], pa.string()), *counts, output], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
                lo = hi

    return run


def fill_in_middle(docs: DataFrame, *, seed: int = 1, plain_share: int = 10, spm_share: int = 20, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, n (units), form, prefix_chars, middle_chars and output.

    ``plain_share`` percent stay plain, ``spm_share`` percent of the others put the suffix first.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), *draws)
    return rows.mapInArrow(_kernel(plain_share, spm_share), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text from which ``fill_in_middle`` made an output of that form."""
    p, s, m = (F.locate(marker, output) for marker in MARKERS)
    end = F.length(output) + 1
    part = lambda lo, hi: F.substring(output, lo + 3, hi - lo - 3)
    psm, spm = F.concat(part(p, s), part(m, end), part(s, m)), F.concat(part(p, m), part(m, end), part(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
