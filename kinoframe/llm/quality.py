"""Quality rules: line-first cleaning.

Rules judge every line: it repeats an earlier one; it is short and does not end a sentence,
or trails off in dots; it has too many symbols, bars or exclamation marks; it is a notice, or
half of it are names of menus and links; it is short and in capitals; it is mostly numbers;
its words stutter. Lines that fail are removed, and a document that loses too large a part
of its words with them is rejected.

Defined results: a null or empty text has no words, fails the base rule and is not
kept; repeated rows are judged alike; lines without a word are neither judged nor
removed; columns beside ``text`` pass through, and the operator's own columns
replace any of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textblocks import BYTE_VALUE, Block, U, blocks, mix, repeated, span_hashes

#: Phrases (lower case) of notices that a page repeats; they condemn a line of few words.
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "terms and conditions", "cookie policy",
    "cookie settings", "accept cookies", "accept all cookies", "use cookies", "uses cookies", "use of cookies",
    "enable javascript", "javascript is disabled", "javascript is required", "lorem ipsum", "powered by wordpress",
    "subscribe to our newsletter", "sign up for our newsletter", "this site is protected by recaptcha", "page not found",
)
#: Phrases (lower case) of menus and links; they condemn a line of which they are half the words or more.
NAVIGATION = (
    "about us", "back to top", "click here", "contact us", "follow us", "home page", "jump to content", "leave a comment", "log in",
    "log out", "main menu", "more info", "next page", "previous page", "read more", "share this", "show more", "sign in", "sign out",
    "sign up", "site map", "skip to content", "skip to main content", "subscribe", "view all", "your cart",
)
#: Characters that end a sentence or close one.
TERMINAL = ".!?\"')]:;\u2026\u201d\u2019\u00bb\u3002\uff01\uff1f\uff1b\uff1a\u300d\u300f\uff09\u3011\u061f\u0964\u0589\u1362"
_TERMINAL = np.array(sorted(map(ord, TERMINAL)))
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
UPPER, LOWER, DIGITS = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"))
#: Bytes that a phrase must not touch: ASCII letters and digits, and all of other characters.
INNER = UPPER | LOWER | DIGITS | (np.arange(256) >= 0x80)
#: Bit 1 for a digit, bit 2 for a letter.
KIND = (DIGITS + 2 * (INNER & ~DIGITS)).astype(np.uint8)
#: Characters of scripts that put no space between words (Thai, Lao, Tibetan, Burmese, Khmer, Kana, Han, full-width).
UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x107F), (0x1780, 0x17FF), (0x3000, 0x9FFF), (0xF900, 0xFAFF), (0xFF00, 0xFFFF), (0x20000, 0x2FFFF))


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules. A line's length is its words, and one for every two characters of scripts
    without spaces; a rate counts characters for each of these.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_rate: float = 0.25
    max_bar_rate: float = 0.15
    max_exclamation_rate: float = 0.5
    short_line: int = 10
    boilerplate_line: int = 20
    max_stutter: float = 0.3
    max_upper: float = 0.6
    max_numbers: float = 0.5
    max_loss: float = 0.5


def _lines(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the \\n-split lines of all texts of the block."""
    n = len(block.bytes)
    cut = np.flatnonzero(block.bytes == 0x0A)
    starts = np.union1d(block.at[:-1], cut + 1)
    starts = starts[starts < n]
    text_end = block.at[np.searchsorted(block.at, starts, "right")]
    return starts, np.minimum(np.r_[cut, n][np.searchsorted(cut, starts)], text_end)


def _unspaced(raw: np.ndarray) -> np.ndarray:
    """Lead bytes of characters of scripts without spaces."""
    out = np.zeros(len(raw), bool)
    if not (raw >= 0xE0).any():
        return out
    second = np.append(raw[1:], 0)
    for lo, hi in UNSPACED:
        first, last = chr(lo).encode(), chr(hi).encode()
        pair = raw.astype(np.int32) << 8 | second
        out |= (raw >= 0xE0) & (pair >= (first[0] << 8 | first[1])) & (pair <= (last[0] << 8 | last[1]))
    return out


def _last_characters(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points of the characters that end at ``ends``."""
    code = raw[ends - 1].astype(np.int64)
    for i in np.flatnonzero(code >= 0x80).tolist():
        at = ends[i] - 1
        while at > 0 and raw[at] & 0xC0 == 0x80:
            at -= 1
        code[i] = ord(raw[at : ends[i]].tobytes().decode("utf-8", "replace")[0])
    return code


def _phrases(block: Block, lower: bytes, starts: np.ndarray, ends: np.ndarray, phrases: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """For each line the number of different phrases it holds as whole words, and the words of these."""
    count, words = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    for p in phrases:
        hits, i = [], lower.find(p.encode())
        while i >= 0:
            hits.append(i)
            i = lower.find(p.encode(), i + 1)
        if hits:
            at = np.array(hits)
            line = np.searchsorted(starts, at, "right") - 1
            at, line = at[line >= 0], line[line >= 0]
            stop = at + len(p)
            whole = (stop <= ends[line]) & ((at == starts[line]) | ~INNER[block.bytes[at - 1]])
            whole &= (stop == ends[line]) | ~INNER[block.bytes[np.minimum(stop, len(block.bytes) - 1)]]
            line = np.unique(line[whole])
            count[line] += 1
            words[line] += p.count(" ") + 1
    return count, words


def judge(block: Block, rules: LineRules) -> dict[str, np.ndarray]:
    """Counts for each text, and which of its lines fail."""
    n_texts, n_words = len(block.at) - 1, block.n_words
    out = {
        "n_words": n_words,
        "word_chars": block.per_text(block.inside & ((block.bytes & 0xC0) != 0x80)),
        "n_symbols": block.per_text(SYMBOLS[block.bytes]),
    }
    words = block.words()
    salt = mix(np.arange(1, n_texts + 1, dtype=U) * U(0x9E3779B97F4A7C15))

    starts, ends = _lines(block)
    lo, hi = np.searchsorted(block.starts, starts), np.searchsorted(block.starts, ends)
    keep = hi > lo
    starts, ends, lo, hi = starts[keep], ends[keep], lo[keep], hi[keep]
    text = block.text_of[lo]
    _, earlier = repeated(mix(span_hashes(BYTE_VALUE[block.bytes], starts, ends) ^ salt[text]))
    out["n_dup_lines"] = np.bincount(text[earlier], minlength=n_texts)

    at, grams = block.grams(words, 3)
    twice, _ = repeated(mix(grams ^ salt[block.text_of[at]]))
    covered = np.zeros(len(words), bool)
    for j in range(3):
        covered[at[twice] + j] = True
    out["n_repeat_words"] = np.bincount(block.text_of[covered], minlength=n_texts)

    def of_line(flags: np.ndarray) -> np.ndarray:
        """Sum over each line: what stands between its end and the next line with a word is white space, which none of the flags marks."""
        return np.add.reduceat(flags, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)

    raw = block.bytes
    n_line = hi - lo
    size = n_line + of_line(_unspaced(raw)) // 2
    stutter = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.r_[False, words[1:] == words[:-1]][: len(words)], out=stutter[1:])
    last = _last_characters(raw, block.ends[hi - 1])
    upper, lower = of_line(UPPER[raw]), of_line(LOWER[raw])
    kinds = np.bitwise_or.reduceat(KIND[raw], block.starts) if len(words) else np.zeros(0, np.uint8)
    number = np.r_[0, np.cumsum(kinds == 1)]
    dots = last == 0x2026
    full = np.flatnonzero(block.ends[hi - 1] - starts >= 3)
    end = block.ends[hi[full] - 1]
    dots[full] |= (raw[end - 1] == ord(".")) & (raw[end - 2] == ord(".")) & (raw[end - 3] == ord("."))
    lowered = raw.tobytes().lower()
    notices, _ = _phrases(block, lowered, starts, ends, BOILERPLATE)
    _, menu = _phrases(block, lowered, starts, ends, NAVIGATION)
    fails = earlier.copy()
    fails |= (~np.isin(last, _TERMINAL) | dots) & (size < rules.short_line)
    fails |= of_line(SYMBOLS[raw]) > rules.max_symbol_rate * size
    fails |= of_line(raw == ord("|")) > rules.max_bar_rate * size
    fails |= of_line(raw == ord("!")) > rules.max_exclamation_rate * size
    fails |= (notices > 0) & (size < rules.boilerplate_line)
    fails |= (menu > 0) & (2 * menu >= n_line)
    fails |= (upper > rules.max_upper * (upper + lower)) & (upper + lower >= rules.short_line) & (size < rules.boilerplate_line)
    fails |= number[hi] - number[lo] > rules.max_numbers * n_line
    fails |= stutter[hi] - stutter[lo + 1] > rules.max_stutter * size
    lost = np.bincount(text, weights=np.where(fails, n_line, 0), minlength=n_texts).astype(np.int64)
    out["n_lost_words"] = lost
    out["base_failed"] = (n_words < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_percent * n_words)
    out["kept"] = ~out["base_failed"] & (lost <= rules.max_loss * n_words)
    out["_failing"] = (starts[fails], text[fails])
    return out


_COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "n_lost_words": "long", "base_failed": "boolean", "kept": "boolean",
}


def _cleaned(block: Block, failing: tuple[np.ndarray, np.ndarray]) -> dict[int, str]:
    """Texts that lose lines, without them."""
    out: dict[int, str] = {}
    starts, texts = failing
    which, first = np.unique(texts, return_index=True)
    for t, lo, hi in zip(which, first, [*first[1:], len(texts)], strict=False):
        gone, at, kept = set(starts[lo:hi].tolist()), int(block.at[t]), []
        for line in block.bytes[at : block.at[t + 1]].tobytes().split(b"\n"):
            if at not in gone:
                kept.append(line)
            at += len(line) + 1
        out[int(t)] = b"\n".join(kept).decode("utf-8", "replace")
    return out


def line_first_quality(docs: DataFrame, rules: LineRules | None = None, *, cleaned: bool = False, text: str = "text") -> DataFrame:
    """``docs`` with the counts and the verdict; ``cleaned`` adds the text without the lines that fail.

    Without ``cleaned`` the text itself isn't returned, so it isn't sent back from Python.
    """
    rules = rules or LineRules()
    own = {*_COLUMNS, "clean_text"}
    carried = [f for f in docs.schema.fields if f.name not in own and (cleaned or f.name != text)]
    schema = T.StructType([*carried, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in _COLUMNS.items())])
    if cleaned:
        schema = schema.add("clean_text", T.StringType())
    names = [f.name for f in carried]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for lo, hi, block in blocks(column):
                got = judge(block, rules)
                arrays = [batch.column(batch.schema.get_field_index(n)).slice(lo, hi - lo) for n in names]
                arrays += [pa.array(got[k], pa.bool_() if v == "boolean" else pa.int64()) for k, v in _COLUMNS.items()]
                if cleaned:
                    texts = column.slice(lo, hi - lo).to_pylist()
                    for i, t in _cleaned(block, got["_failing"]).items():
                        texts[i] = t
                    arrays.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *_COLUMNS, *(["clean_text"] if cleaned else [])])

    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)
