"""Column functions over text, paths and JSON."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: caption line written where a clip has no signal.
PLACEHOLDER_CAPTION = "a person moves#a/DET person/NOUN moves/VERB#0.0#0.0\n"
#: Words that are never tags.
STOP_WORDS = ("a", "an", "the", "in", "on", "by", "at", "near", "of", "and", "to", "is", "are")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Last suffix in lower case with its dot, or nothing."""
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]+)$", 1))


def stable_id(path: Column) -> Column:
    """Stem with other than letters, digits, ``-`` and ``_`` replaced, and eight digits of the path's sha1."""
    return F.concat(F.regexp_replace(stem(path), r"[^\p{L}\p{N}_-]", "_"), F.lit("_"), F.substring(F.sha1(path), 1, 8))


def camera_of(path: Column, depth: int) -> Column:
    """First ``depth`` folders of the path; ``cam`` where there are none."""
    parts = F.split(path, "/")
    if depth <= 0:
        return F.lit("cam")
    folders = F.slice(parts, F.lit(1), F.least(F.lit(depth), F.size(parts) - 1))
    return F.when(F.size(parts) <= 1, "cam").otherwise(F.array_join(folders, "/"))


def glob_match(path: Column, patterns: list[str]) -> Column:
    """Whether a case-sensitive glob matches the whole path; ``*`` crosses ``/``."""
    regex = "|".join(f"(?:{fnmatch.translate(p)})" for p in patterns)
    # Python's \Z is Java's \z.
    return path.rlike("^(?:" + regex.replace(r"\Z", r"\z").replace("(?>", "(?:") + ")") if patterns else F.lit(False)


def caption_line(caption: Column) -> Column:
    """``text#token/OTHER ...#0.0#0.0`` with ``#`` and runs of white space made single spaces."""
    text = F.trim(F.regexp_replace(F.regexp_replace(caption, "#", " "), r"\s+", " "))
    tokens = F.array_join(F.transform(F.split(text, " "), lambda w: F.concat(F.lower(w), F.lit("/OTHER"))), " ")
    return F.when(text == "", PLACEHOLDER_CAPTION).otherwise(F.concat(text, F.lit("#"), tokens, F.lit("#0.0#0.0\n")))


def clip_caption(conditioning: str, action: Column, caption: Column, person: Column) -> Column:
    """Caption line of a clip under a conditioning mode, the placeholder where its signal is missing."""
    label = F.concat(F.lit("action "), action.cast("string"))
    by_action = F.concat(label, F.lit("#"), F.regexp_replace(label, " ", "/NOUN "), F.lit("/NUM#0.0#0.0\n"))
    modes = {"action": (action, by_action), "text": (F.nullif(caption, F.lit("")), caption_line(caption)), "person": (F.nullif(person, F.lit("")), caption_line(person))}
    if conditioning not in modes:
        return F.lit(PLACEHOLDER_CAPTION)
    signal, line = modes[conditioning]
    return F.when(signal.isNotNull(), line).otherwise(PLACEHOLDER_CAPTION)


def first_json_object(text: Column) -> Column:
    """The text from its first ``{`` to its last ``}``."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def first_integer(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\d+", 0), F.lit("")).cast("long")


def import_status(status: Column) -> Column:
    """Queue status of a free-form one; ``excluded`` stays excluded, so what was taken out doesn't come back."""
    low = F.lower(status)
    return (
        F.when(low.contains("exclude"), "excluded")
        .when(low.contains("fail"), "failed")
        .when(low.contains("done") | low.contains("pose") | low.contains("complete"), "done")
        .otherwise("pending")
    )


def contains_query(query: str, *columns: Column) -> Column:
    """Substring search in any of the columns, blind to ASCII case; ``%`` and ``_`` are wildcards."""
    out = F.lit(False)
    for c in columns:
        out = out | c.ilike(f"%{query}%")
    return out


def terms(text: Column) -> Column:
    """Lower-case runs of ASCII letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z]+)"))


def reply_label(text: Column) -> tuple[Column, Column]:
    """(description, tags) of the JSON object in a model's reply, trimmed, empty tags dropped."""
    label = F.from_json(first_json_object(text), "description string, tags array<string>")
    tags = F.filter(F.transform(label["tags"], lambda t: F.trim(t)), lambda t: t != "")
    return F.trim(F.coalesce(label["description"], F.lit(""))), F.coalesce(tags, F.array().cast("array<string>"))


def utc_text(at: Column) -> Column:
    """A timestamp in UTC to the second, as ISO text."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
