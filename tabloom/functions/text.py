"""Trimming, null tokens, names and lengths."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Characters removed at both ends of a string value.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Strings read as missing.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_token(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    trimmed = strip(c)
    return F.when(~trimmed.isin(*tokens), trimmed)


def text_length(c: Column) -> Column:
    return F.length(F.coalesce(c.cast("string"), F.lit("")))


def contains_any(c: Column, *parts: str) -> Column:
    """Case-blind test for any of the given literal parts; a missing text contains nothing."""
    return F.lower(F.coalesce(c, F.lit(""))).rlike("|".join(re.escape(p) for p in parts))


def first_part(c: Column, separator: str) -> Column:
    return F.split_part(c, F.lit(separator), F.lit(1))


def join_labels(*cols: Column, separator: str = " | ", missing: str = "Unknown") -> Column:
    return F.concat_ws(separator, *(F.coalesce(c.cast("string"), F.lit(missing)) for c in cols))


def label_or(c: Column, label: str = "Unknown", *, merge_unknown: bool = False) -> Column:
    """Missing values become label; with merge_unknown the text 'Unknown' does too."""
    text = c.cast("string")
    if merge_unknown:
        text = F.nullif(text, F.lit("Unknown"))
    return F.coalesce(text, F.lit(label))


def alnum_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def alnum_name(name: str) -> str:
    """The same for a column's name: letters and digits of any script, in lower case."""
    return re.sub(r"[\W_]", "", name.lower())


def underscored(name: str) -> str:
    return name.replace(" ", "_")


def slug(c: Column) -> Column:
    """Lower case, brackets removed with their text, '+' spelled out, other runs turned into one '_'."""
    bare = F.regexp_replace(F.lower(strip(c)), r"\([^)]*\)", "")
    spelled = F.replace(bare, F.lit("+"), F.lit("plus"))
    return F.btrim(F.regexp_replace(spelled, r"[^a-z0-9]+", "_"), F.lit("_"))


def folder_slug(c: Column) -> Column:
    return F.translate(c, "/ ", "__")
