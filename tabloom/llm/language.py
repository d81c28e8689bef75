"""Language ID by a Bloom filter whose slots hold a bit for each language.

Each four-byte gram of a language's texts sets the language's bit in a few slots; the AND of a gram's slots gives all
languages that contain it. A text's bits are counted per language, the counts freed of the hits that chance alone
gives, divided by the share that texts of the language reach, and the largest decides.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabloom.llm.texts import byte_slices, kept as caches_kept
from tabloom.session import text_batches

UNKNOWN = "und"
PLANE_BITS = 64
HASHES = 2
SLICE_BYTES = 1 << 19  # grams and their bounds take about 60 bytes for each byte of text
SPACE = 32

# Letters in lower case, bytes beyond ASCII as they are, all else white space.
FOLD = np.full(256, SPACE, dtype=np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte grams of all rows, with white space before and after each row, and the bounds of each row's grams.

    Grams with two spaces side by side within count for nothing and are left out.
    """
    lengths = ends - starts
    padded = np.full(int(lengths.sum()) + 2 * (len(starts) + 1), SPACE, dtype=np.uint8)
    first = starts - starts[0] + 2 * np.arange(1, len(starts) + 1) if len(starts) else starts
    place = np.arange(len(data)) + 2 * np.repeat(np.arange(1, len(starts) + 1), lengths)
    padded[place] = FOLD[data]
    a = padded.astype(np.uint32)
    found = (a[:-3] << 24) | (a[1:-2] << 16) | (a[2:-1] << 8) | a[3:]
    blank = padded == SPACE
    twice = blank[:-1] & blank[1:]
    fine = ~(twice[:-2] | twice[1:-1] | twice[2:])
    count = np.concatenate([[0], np.cumsum(fine)])
    low, high = np.minimum(first - 1, len(found)), np.minimum(first + lengths - 2, len(found))
    return found[fine], np.stack([count[low], count[np.maximum(low, high)]], axis=1)


@dataclass
class LanguageFilter:
    """slots has a row for each 64 languages; a language's bit stands in the row of its number."""

    languages: list[str]
    slots: np.ndarray
    chance: np.ndarray
    reach: np.ndarray
    fallback: int

    def places(self, found: np.ndarray) -> list[np.ndarray]:
        shift = np.uint32(33 - self.slots.shape[1].bit_length())
        mixed = found ^ (found >> np.uint32(15))
        # Odd multipliers for spreading grams over slots.
        return [(mixed * np.uint32(m)) >> shift for m in (2654435761, 2246822519)][:HASHES]

    def lookup(self, found: np.ndarray) -> np.ndarray:
        a, b = self.places(found)
        return self.slots[:, a] & self.slots[:, b]

    def bits(self, masks: np.ndarray, k: int) -> np.ndarray:
        """Language k's bits of masks (or of the slots)."""
        kind = masks.dtype.type
        return (masks[k // PLANE_BITS] >> kind(k % PLANE_BITS)) & kind(1)

    def decide(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found, bounds = grams(data, starts, ends)
        masks = self.lookup(found)
        hits = np.zeros((len(starts), len(self.languages)))
        for k in range(len(self.languages)):
            counted = np.concatenate([[0], np.cumsum(self.bits(masks, k), dtype=np.int64)])
            hits[:, k] = counted[bounds[:, 1]] - counted[bounds[:, 0]]
        n = (bounds[:, 1] - bounds[:, 0])[:, None]
        true = np.maximum(0.0, (hits - n * self.chance) / np.maximum(1e-9, 1 - self.chance))
        share = np.where(n > 0, true / np.maximum(n, 1) / self.reach, 0.0)
        best = np.where(share.max(axis=1) > 0, share.argmax(axis=1), self.fallback)
        return best, np.clip(share.max(axis=1), 0.0, 1.0)


def count_grams(batches: Iterator[pa.RecordBatch], place: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """(language's number, gram, count) for the grams of runs of rows of batches (text, language)."""
    for batch in batches:
        of = np.array([place[x] for x in batch.column(1).to_pylist()])
        for first, data, starts, ends in byte_slices(batch.column(0), SLICE_BYTES):
            found, bounds = grams(data, starts, ends)
            lang = np.repeat(of[first : first + len(starts)], bounds[:, 1] - bounds[:, 0])
            inside = np.zeros(len(found) + 1, dtype=np.int64)
            np.add.at(inside, bounds[:, 0], 1)
            np.add.at(inside, bounds[:, 1], -1)
            keys, n = np.unique((lang.astype(np.int64) << 32) | found[np.cumsum(inside)[:-1] > 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


def fit_filter(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = 10_000, grams_per_language: int = 60_000, slot_bits: int = 20) -> LanguageFilter:
    """Fit on rows where learn holds and text and language are not null.

    Of each language at most about fit_rows rows are read, chosen by a hash of the id: the fit's size is bounded, and
    with fewer rows all are used. A language holds a gram if the gram's share among its grams is at least an eighth of
    the largest share in any language; the most frequent grams_per_language of them enter the filter. Any number of
    languages; the filter has a bit for each in every slot.
    """
    text_batches(docs.sparkSession)
    known = docs.filter(learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row a language
    languages = sorted(counts)
    if not languages:
        return LanguageFilter([UNKNOWN], np.zeros((1, 1 << slot_bits), np.uint8), np.zeros(1), np.ones(1), 0)
    space = 1 << 30
    share = F.try_element_at(F.from_json(F.lit(json.dumps({x: min(space, space * fit_rows // counts[x]) for x in languages})), "map<string,bigint>"), F.col("lang"))
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(space)) < share)
    place = {x: k for k, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches_kept("language", dict)  # lets go of what other operators' tasks have left in this process
        return count_grams(batches, place)

    counted = chosen.select("text", "lang").mapInArrow(count, "lang long, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = Window.partitionBy("lang")
    shares = counted.withColumn("share", F.col("n") / F.sum("n").over(totals))
    contained = shares.withColumn("most", F.max("share").over(Window.partitionBy("gram"))).filter((F.col("share") * 8 >= F.col("most")) & (F.col("n") >= 2))
    top = contained.withColumn("place", F.row_number().over(totals.orderBy(F.desc("n"), "gram"))).filter(F.col("place") <= grams_per_language)
    rows = top.select("lang", "gram", "share").toPandas()  # at most grams_per_language rows a language

    kind = next((t for bits, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32)) if len(languages) <= bits), np.uint64)
    out = LanguageFilter(languages, np.zeros((-(-len(languages) // PLANE_BITS), 1 << slot_bits), kind), np.zeros(len(languages)), np.ones(len(languages)), 0)
    out.fallback = max(range(len(languages)), key=lambda k: (counts[languages[k]], -k))
    for k in range(len(languages)):
        mine = rows[rows["lang"] == k]
        for at in out.places(mine["gram"].to_numpy(dtype=np.uint32)):
            out.slots[k // PLANE_BITS, np.unique(at)] |= kind(1 << k % PLANE_BITS)
        out.reach[k] = max(1e-9, float(mine["share"].sum()))
        out.chance[k] = float(out.bits(out.slots, k).mean()) ** HASHES
    return out


def identify(docs: DataFrame, fitted: LanguageFilter, *, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """All rows and columns of docs with the predicted language and its score, from each row's whole text alone.

    `und` with score 0 if the text is null or has no letter. A text none of whose grams is known gets the most frequent
    learned language with score 0; equal shares give the first language in name order. Repeated rows stay; an empty
    table gives none. Columns that docs has under the two new names are replaced.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)  # slots and a few numbers per language
    kept = [c for c in docs.columns if c not in (pred_col, score_col)]
    # Columns travel under numbers, so that no name can clash.
    names = [f"c{k}" for k in range(len(kept))]
    fields = [T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, kept)]
    schema = T.StructType([*fields, T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches_kept("language", dict)
        model = shared.value
        for batch in batches:
            languages, scores = [], [np.empty(0)]
            lettered = batch.column(1).to_numpy(zero_copy_only=False)
            for first, data, starts, ends in byte_slices(batch.column(0), SLICE_BYTES):
                best, score = model.decide(data, starts, ends)
                fine = lettered[first : first + len(starts)]
                languages += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, fine)]
                scores.append(np.where(fine, score, 0.0))
            columns = [*batch.columns[2:], pa.array(languages, pa.string()), pa.array(np.concatenate(scores))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang", "score"])

    source = docs.select(F.col(f"`{text_col}`").alias("text"), has_letter(text_col).alias("lettered"), *[F.col(f"`{c}`").alias(n) for n, c in zip(names, kept)])
    return source.mapInArrow(run, schema).toDF(*kept, pred_col, score_col)


def has_letter(text_col: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_languages(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """Fit on the rows that are not held out, predict all. held_out follows from the id alone; null ids are not held out."""
    fitted = fit_filter(docs, ~held_out(id_col), id_col=id_col, **options)
    texts = docs.select(id_col, options.get("text_col", "text"))
    return identify(texts, fitted, text_col=options.get("text_col", "text")).select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
