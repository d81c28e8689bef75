"""Importance resampling towards a target: hashed n-gram counts of both sides, then a seeded draw of the best scores.

Texts become byte strings with single spaces between words. One pattern, bounded by look-arounds and scanned with
overlaps, finds the spans of all runs of a number of words; each span's bytes go to a bucket by their crc32. How often
the buckets occur in all documents and in the target texts gives each bucket a gain, a document's weight is the sum of
its gains, and noise from a hash of the id turns taking the best scores into a draw by weight.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.ordered import number_rows
from tabloom.session import stash

FEWEST, MOST = 1, 1  # words in a run
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
SCALE = 1000
PIECE_BYTES = 1 << 20
KNOWN_WORDS = 1 << 16

# Letters a-z (A-Z become these), digits and all bytes of other code points stay; the rest separates.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@lru_cache(maxsize=8)
def run_pattern(words: int) -> regex.Pattern:
    """Spans of so many words of a text with single spaces."""
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (words - 1))


@lru_cache(maxsize=KNOWN_WORDS)
def bucket_of(span: bytes, buckets: int) -> int:
    return zlib.crc32(span) % buckets


def text_pieces(data: bytes, words: int, limit: int = PIECE_BYTES) -> Iterator[bytes]:
    """The words of data with single spaces, in pieces of about limit bytes that repeat the words - 1 before them.

    Each run of so many words stands in exactly one piece, so memory follows the piece, not the text's spans.
    """
    plain = data.translate(PLAIN)
    at, kept = 0, []
    while at < len(plain):
        end = at + limit
        if end < len(plain):
            cut = plain.find(b" ", end)
            end = len(plain) if cut < 0 else cut
        own = plain[at:end].split()
        if own:
            yield b" ".join([*kept, *own])
            kept = [*kept, *own][-(words - 1) :] if words > 1 else []
        at = end


def run_counts(data: bytes, words: int) -> Counter[bytes]:
    """How often each run of so many words occurs in a text."""
    counts: Counter[bytes] = Counter()
    for piece in text_pieces(data, words):
        counts.update(m.group() for m in run_pattern(words).finditer(piece, overlapped=True))
    return counts


def bucket_counts(data: bytes, fewest: int, most: int, buckets: int) -> tuple[dict[int, int], int]:
    """Occurrences of each bucket among a text's runs, and its number of words."""
    found: Counter[int] = Counter()
    n_words = 0
    for words in range(fewest, most + 1):
        counts = run_counts(data, words)
        for span, often in counts.items():
            found[bucket_of(span, buckets)] += often
        if words == 1:
            n_words = counts.total()
    if fewest > 1:
        n_words = sum(piece.count(b" ") + 1 for piece in text_pieces(data, 1))
    return found, n_words


def hashed_runs(docs: DataFrame, *, text_col: str, fewest: int, most: int, buckets: int, keep: list[str]) -> DataFrame:
    """The kept columns with n_words, and each text's buckets with their counts as two lists; null texts have none."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [bucket_counts(x.as_py() or b"", fewest, most, buckets) for x in batch.column(batch.num_columns - 1)]
            starts = np.concatenate([[0], np.cumsum([len(found) for found, _ in rows])]).astype(np.int32)
            places = pa.array([k for found, _ in rows for k in found], pa.int32())
            times = pa.array([v for found, _ in rows for v in found.values()], pa.int64())
            lists = [pa.ListArray.from_arrays(pa.array(starts), x) for x in (places, times)]
            columns = [*batch.columns[:-1], pa.array([n for _, n in rows], pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "buckets", "counts"])

    source = docs.select(*keep, F.col(text_col).cast("binary").alias("_bytes"))
    return source.mapInArrow(run, ", ".join(filter(None, [kinds, "n_words long, buckets array<int>, counts array<long>"])))


def bucket_totals(hashed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, times) over all rows; each task sums its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            np.add.at(sums, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used], pa.int64())], names=["bucket", "times"])

    parts = hashed.select("buckets", "counts").mapInArrow(run, "bucket int, times long")
    return parts.groupBy("bucket").agg(F.sum("times").alias("times"))


def bucket_gains(own: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket: the log ratio of its smoothed shares in target and own, times SCALE, rounded down."""
    every = own.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    sides = [x.select("bucket", F.col("times").alias(name)) for x, name in ((own, "s"), (target, "t"))]
    both = every.join(sides[0], "bucket", "left").join(sides[1], "bucket", "left").fillna(0, ["s", "t"])
    total_own, total_target = (x.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0] for x in (own, target))
    ratio = (F.col("t") + 1.0) * F.lit(float(total_own + buckets)) / ((F.col("s") + 1.0) * F.lit(float(total_target + buckets)))
    return both.select("bucket", F.floor(F.lit(float(SCALE)) * F.ln(ratio)).cast("long").alias("gain"))


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-SCALE ln(-ln u)), u from the first 8 hex digits of sha256(`seed:id`); a null id is the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weighed(hashed: DataFrame, gains: list[int], keep: list[str]) -> DataFrame:
    """The kept columns with n_words, n_features and weight."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hashed.select(*keep).schema)
    shared = hashed.sparkSession.sparkContext.broadcast(np.array(gains, dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, times = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1).flatten().to_numpy()
            ends = np.cumsum([0, *(len(x) for x in lists)])
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times, times * shared.value[lists.flatten().to_numpy()])]
            features, weight = (s[ends[1:]] - s[ends[:-1]] for s in sums)
            columns = [*batch.columns[:-2], pa.array(features, pa.int64()), pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "n_features", "weight"])

    return hashed.select(*keep, "n_words", "buckets", "counts").mapInArrow(run, ", ".join(filter(None, [kinds, "n_words long, n_features long, weight long"])))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    fewest: int = FEWEST,
    most: int = MOST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of docs: id, n_features, weight, score, rank among the drawn ones from 1, null for the others.

    Null and empty texts have no feature and weight 0. Of the rows with at least least_words words, percent of a hundred
    (rounded down) are drawn, highest scores first, then smaller ids, null ids last; rows equal in both in any order,
    each counted. An empty target leaves only the smoothing; empty docs give no rows.
    """
    kept = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    hashed = stash(hashed_runs(kept, text_col="_text", fewest=fewest, most=most, buckets=buckets, keep=["_id"]))
    wanted = hashed_runs(target, text_col=target_text_col, fewest=fewest, most=most, buckets=buckets, keep=[])
    sides = [stash(bucket_totals(x, buckets)) for x in (hashed, wanted)]
    gains = [r["gain"] for r in bucket_gains(*sides, buckets).orderBy("bucket").collect()]  # one number a bucket
    rows = weighed(hashed, gains, ["_id"]).withColumn("score", F.col("weight") + noise(F.col("_id"), seed))
    rows = stash(rows.withColumn("_row", F.monotonically_increasing_id()))
    eligible = F.col("n_words") >= least_words
    drawn = rows.filter(eligible).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("_id"), F.asc("_row")]
    ranked = number_rows(rows.filter(eligible), order, name="_place", start=1)
    told = ranked.withColumn("rank", F.when(F.col("_place") <= drawn, F.col("_place"))).drop("_place")
    rest = rows.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return told.unionByName(rest).select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")
