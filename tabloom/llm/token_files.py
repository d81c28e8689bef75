"""Token files: Parquet with one list of ids per document, made for selective reads.

Files hold consecutive ids of documents, rows stand in that order. Ids are dictionary-encoded, counts and document ids
delta-encoded (second version of the format's pages). Row groups and pages are small, and Spark's writer adds column and
offset indexes, so a read of a few documents or of the counts alone skips the rest.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabloom.llm.texts import ASCII_SPACE, byte_slices, chunk_starts, kept
from tabloom.session import new_folder, shuffle_partitions, text_batches

CACHE_ENTRIES = 600_000
RUN_CHUNKS = 64
RUN_BYTES = 4 << 20
MARKED_WORD = re.compile(r"([ \n\t\r]*\w*[^\W_])([^\w\s]+)\Z")
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(128 << 10),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


class CachedTokenizer:
    """A tokenizer of the tokenizers library that meets frequent chunks of text once.

    Chunks are encoded apart, which gives the same ids as the whole text (see chunk_starts); a text that can't be
    cut this way is encoded whole. The cache has two generations of CACHE_ENTRIES chunks: its memory is bounded, and
    chunks in use outlive those met once.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.token_bytes[number] = len(token)  # a byte-level token has one character for each byte
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _encode_chunks(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        """Chunks with white space before other text are encoded as runs of text and told apart by their bytes."""
        inner = [c for c in chunks if c[0] in ASCII_SPACE and c[-1] not in ASCII_SPACE]
        if len(inner) < len(chunks):
            apart = [c for c in chunks if c[0] not in ASCII_SPACE or c[-1] in ASCII_SPACE]
            yield from zip(apart, self._encode(apart))
        if not inner:
            return
        runs = ["".join(inner[k : k + RUN_CHUNKS]) for k in range(0, len(inner), RUN_CHUNKS)]
        raw = b"".join(self._encode(runs))
        tokens = np.cumsum(self.token_bytes[np.frombuffer(raw, dtype="<i4")])
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, inner)), dtype=np.int64, count=len(inner)))
        last = np.searchsorted(tokens, ends)
        if tokens[-1] != ends[-1] or (tokens[last] != ends).any():
            raise ValueError("a token spans two chunks: the vocabulary is not byte-level")
        cuts = (4 * (last + 1)).tolist()
        yield from zip(inner, map(raw.__getitem__, map(slice, [0, *cuts[:-1]], cuts)))

    def _learn(self, missing: set[str]) -> None:
        """Put chunks that the cache lacks into it; those of the older generation are carried over.

        A word with marks after it is put together from the two, which the split pattern never joins.
        """
        if len(self.cache) + len(missing) > CACHE_ENTRIES:
            self.older, self.cache = self.cache, {}
        cache = self.cache
        met = {*filter(self.older.__contains__, missing)}  # asks for the few missing ones, not for all that are kept
        cache.update((c, self.older[c]) for c in met)
        new = missing.difference(met)
        marked = [m.groups() for m in map(MARKED_WORD.match, [c for c in new if not c[-1].isalnum()]) if m]
        new.difference_update(map("".join, marked))
        parts = {*chain.from_iterable(marked)}.difference(new).difference(cache)
        met = {*filter(self.older.__contains__, parts)}
        cache.update((c, self.older[c]) for c in met)
        cache.update(self._encode_chunks([*new, *parts.difference(met)]))
        cache.update((word + marks, cache[word] + cache[marks]) for word, marks in marked)

    def _ids_of(self, chunks: list[str], apart: set[str]) -> list[bytes]:
        """Ids of different chunks; those that the caches lack are learned first, but for apart, encoded one by one and not kept."""
        found = [*map(self.cache.get, chunks)]
        gaps = [k for k, ids in enumerate(found) if ids is None]
        missing = [*map(chunks.__getitem__, gaps)]
        self._learn({*missing}.difference(apart))
        for k, ids in zip(gaps, map(self.cache.get, missing)):
            found[k] = ids or self._encode([chunks[k]])[0]
        return found

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, number of ids of each row) for runs of rows of a column of texts.

        A run's different chunks are told apart by Arrow and looked up once; its ids are gathered by their numbers.
        """
        for _, data, starts, ends in byte_slices(column, RUN_BYTES):
            first, whole = chunk_starts(data, starts, ends)
            bounds = np.append(first, len(data)).astype(np.int32)
            coded = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
            apart = {data[starts[row] : ends[row]].tobytes().decode() for row in whole}
            found = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), apart)
            known = np.frombuffer(b"".join(found), dtype="<i4")
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
            number = coded.indices.to_numpy()
            own = sizes[number]
            upto = np.concatenate([[0], np.cumsum(own)])
            ids = known[np.repeat((np.cumsum(sizes) - sizes)[number] - upto[:-1], own) + np.arange(upto[-1])]
            yield ids, upto[np.searchsorted(first, ends)] - upto[np.searchsorted(first, starts)]


def tokenizer(path: str) -> CachedTokenizer:
    return kept(("tokenizer", path), lambda: CachedTokenizer(path))


def write_tokens(docs: DataFrame, target: str, *, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> None:
    """Encode all texts and write them in ascending order of their ids, end_id after each.

    path: the tokenizer's file, readable on all executors. Null counts as empty: a row with the end id only. Rows of
    equal ids are ordered by a hash of their texts; null ids come first. No rows give a folder with the schema.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = tokenizer(path)
        for batch in batches:
            row = 0
            for ids, sizes in codec.encode(batch.column(1)):
                values = np.insert(ids, np.cumsum(sizes), end_id)
                counts = (sizes + 1).astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(counts)), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "n_tokens", "ids"])
                row += len(counts)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    ordered = source.repartitionByRange(files or shuffle_partitions(docs), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    encoded = ordered.mapInArrow(run, f"doc_id {id_type}, n_tokens int, ids array<int>")
    encoded.withColumn("file", F.spark_partition_id()).write.options(**WRITE_OPTIONS).parquet(target)


def read_tokens(spark: SparkSession, target: str, *columns: str) -> DataFrame:
    """Rows of token files; name the columns to read only those, filter on doc_id to read only the pages with it."""
    rows = spark.read.parquet(target)
    return rows.select(*columns) if columns else rows


def token_starts(spark: SparkSession, target: str) -> DataFrame:
    """(file, first token of the file, rows): from the counts alone, one row per file."""
    sums = read_tokens(spark, target, "file", "n_tokens").groupBy("file").agg(F.sum(F.col("n_tokens").cast("long")).alias("_tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", F.coalesce(F.sum("_tokens").over(before), F.lit(0)).alias("_offset"))


def token_index(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and crc32 of its ids, read back from the files."""

    id_type = spark.read.parquet(target).schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, bounds = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
            crcs = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crcs, pa.int64())], names=["doc_id", "n_tokens", "file", "ids_crc32"])

    rows = read_tokens(spark, target, "doc_id", "n_tokens", "file", "ids").mapInArrow(run, f"doc_id {id_type}, n_tokens int, file int, ids_crc32 long")
    # A file's rows are in order; a tie in doc_id is settled by the checksum, as good as any.
    own = Window.partitionBy("file").orderBy("doc_id", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(F.col("n_tokens").cast("long")).over(own), F.lit(0))
    offsets = token_starts(spark, target)  # one row per file
    placed = rows.withColumn("_within", within).join(F.broadcast(offsets), "file")
    return placed.select("doc_id", (F.col("_offset") + F.col("_within")).cast("long").alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")


def index_documents(docs: DataFrame, *, path: str, **options) -> DataFrame:
    """Write all documents to a new folder of token files in the shared folder and index what is read back."""
    target = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, target, path=path, **options)
    return token_index(docs.sparkSession, target)
