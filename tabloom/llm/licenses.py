"""License scan: an exact containment join of text blocks with templates.

A template is a set of words. Its words are put in order of their frequency in the whole corpus, rarest first. A block
that holds at least a share t of n words lacks at most n - ceil(t n) of them, so it holds one of the first
n - ceil(t n) + 1 (prefix filter). Only blocks with such a word go on; of these, only blocks with enough words (length
filter) and, for the j-th word of the order as the first one found, n - j words still to come (positional filter).

Two kinds of blocks are scanned: the lines of a text for templates, and every place of the text for phrases, whose
words must stand one after the other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.native import bound_once, whole

# Phrases and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
# Well-known license notices and the labels of their families.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words in A-Z lower case; every ASCII character but letters and digits separates."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != "")


def _folded(word: str) -> str:
    """Regular expression for a word of a phrase in any case of A-Z."""
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.isalpha() else c for c in word)


def _alternation(words: list[str]) -> str:
    """Finds texts that have one of the words; a text that passes is split and compared in full."""
    return "|".join(_folded(w) for w in sorted(words))


@dataclass(frozen=True)
class Template:
    words: tuple[str, ...]
    label: str
    threshold: float
    phrase: bool

    @property
    def needed(self) -> int:
        return math.ceil(self.threshold * len(self.words) - 1e-9)

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.needed + 1]


def word_frequencies(texts: DataFrame, text_col: str, vocabulary: list[str]) -> dict[str, int]:
    """Lines of all texts that hold each word of the templates; one aggregate row, as wide as the vocabulary."""
    text = whole(F.col(text_col))
    edge = r"(?:^|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])"
    hits = texts.filter(text.rlike(_alternation(vocabulary))).select(bound_once(F.array_distinct(words_of(text)), lambda w: F.array_intersect(w, F.array(*map(F.lit, vocabulary)))).alias("w"))
    counted = hits.select(F.explode("w").alias("w")).groupBy("w").count().collect()
    return {w: 0 for w in vocabulary} | {r["w"]: r["count"] for r in counted}


def ordered_templates(frequencies: dict[str, int], templates, phrases, threshold: float) -> list[Template]:
    def of(text: str, label: str, t: float, phrase: bool) -> Template:
        words = dict.fromkeys(text.split())
        return Template(tuple(sorted(words, key=lambda w: (frequencies[w], w))), label, t, phrase)

    return [of(x, label, threshold, False) for x, label in templates] + [of(x, label, 1.0, True) for x, label in phrases]


def _line_score(words: Column, t: Template) -> Column:
    """Containment of the template in a line's word set, 0 where a filter rules the line out."""
    n = len(t.words)
    found = F.size(F.array_intersect(words, F.array(*map(F.lit, t.words)))) / F.lit(float(n))
    first = reduce(lambda rest, j: F.when(F.array_contains(words, t.words[j]), F.lit(n - j)).otherwise(rest), reversed(range(len(t.prefix))), F.lit(0))
    return F.when((F.size(words) >= t.needed) & (first >= t.needed) & (found >= t.threshold - 1e-9), found).otherwise(F.lit(0.0))


def _places(words: Column, phrase: list[str], anchor: int) -> Column:
    """Places where the phrase starts; the rarest word of the phrase is looked up first."""
    n = len(phrase)
    at = F.filter(F.transform(words, lambda w, i: F.when(w == phrase[anchor], i - anchor)), lambda i: i.isNotNull() & (i >= 0) & (i + n <= F.size(words)))
    follows = lambda i: reduce(lambda a, b: a & b, [F.get(words, i + F.lit(j)) == phrase[j] for j in range(n)])
    return F.filter(at, follows)


def _column_of(matrix: str, k: int) -> Column:
    return F.transform(matrix, lambda row: F.get(row, F.lit(k)))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES, threshold: float = 0.9) -> DataFrame:
    """One row per row of docs: id, n_words, places of phrases, labels of phrases and templates, best containment.

    score is the largest containment of any template in any line, 1 where a phrase is found, 0 where nothing is.
    Null and empty texts have no words, no places (null), empty labels and score 0; repeated rows stay; an empty table
    gives none; other columns are not read. Texts are scanned whole, at any length.
    """
    vocabulary = sorted({w for x, _ in [*templates, *phrases] for w in x.split()})
    ordered = ordered_templates(word_frequencies(docs, text_col, vocabulary), templates, phrases, threshold)
    lines, spans = [t for t in ordered if not t.phrase], [(t, x.split()) for t, (x, _) in zip([t for t in ordered if t.phrase], phrases)]
    text = whole(F.col("_text"))
    base = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    line_prefix, phrase_prefix = sorted({w for t in lines for w in t.prefix}), sorted({t.prefix[0] for t, _ in spans})

    with_prefix = F.filter(F.split(text, "\n"), lambda x: x.rlike(_alternation(line_prefix)))

    def scored(found_lines: Column) -> Column:
        """For each line with a prefix word, its score under each template."""
        return F.transform(found_lines, lambda x: bound_once(F.array_distinct(words_of(x)), lambda w: F.array(*[_line_score(w, t) for t in lines])))

    empty = F.expr("cast(array() as array<array<double>>)")
    line_scores = F.when(text.rlike(_alternation(line_prefix)), scored(with_prefix)).otherwise(empty) if lines else empty
    places = F.when(
        text.rlike(_alternation(phrase_prefix)),
        bound_once(words_of(text), lambda w: F.array(*[_places(w, p, p.index(t.prefix[0])) for t, p in spans])),
    ).otherwise(F.array_repeat(F.expr("cast(array() as array<int>)"), len(spans)))
    found = base.select(id_col, F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), line_scores.alias("_lines"), places.alias("_places"))
    best = [F.coalesce(F.array_max(_column_of("_lines", k)), F.lit(0.0)).alias(f"_best{k}") for k in range(len(lines))]
    told = found.select("*", F.flatten("_places").alias("_all"), *best)

    base_labels = [F.when(F.size(F.get("_places", F.lit(k))) > 0, F.lit(t.label)) for k, (t, _) in enumerate(spans)]
    own_labels = [F.when(F.col(f"_best{k}") > 0, F.lit(t.label)) for k, t in enumerate(lines)]
    joined = lambda parts: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*parts)))), ",")
    return told.select(
        id_col,
        "n_words",
        F.size("_all").cast("long").alias("n_base"),
        F.array_min("_all").cast("long").alias("first_word"),
        F.array_max("_all").cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined([*base_labels, *own_labels]).alias("labels"),
        F.greatest(F.when(F.size("_all") > 0, F.lit(1.0)).otherwise(F.lit(0.0)), *[F.col(f"_best{k}") for k in range(len(lines))], F.lit(0.0)).alias("score"),
    )
