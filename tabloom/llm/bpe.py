"""Byte-level BPE as a reduction over a tree of text parts.

Encodings of neighbouring parts are joined by encoding a window around their border anew. The window grows until the
tokens outside it are proved to stay: a token sequence is the encoding of its bytes if and only if each two neighbours
encode to themselves, because the merges inside two neighbours come in the same order with or without the rest. So a
join is right as soon as the window's outer tokens are stable next to the tokens outside.

A text is cut in halves at places where the split pattern cuts whatever stands around, a piece of the pattern in halves
of its bytes. Decoding concatenates the tokens' bytes up the same tree.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from itertools import chain, compress, count, pairwise
from operator import not_

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.texts import ASCII_SPACE, independent_chunks, kept
from tabloom.session import text_batches

LEAF_BYTES = 16
LEAF_CHARS = 1 << 16
RUN_CHARS = 1 << 18  # of short texts whose new pieces are merged together
NEVER = (1 << 31) - 1  # beyond all ranks
CACHE_ENTRIES, CACHE_PIECES = 120_000, 50_000  # pieces are asked for only where their chunk is new


class BytePairs:
    """Encoder and decoder for a file of ranks (base64 of a token's bytes, rank) and a split pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        # White space by Unicode's property; the library's own class has four control characters more.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        byte_ranks = [self.ranks.get(bytes([k]), -1) for k in range(256)]
        self.byte_ranks = np.array(byte_ranks, dtype=np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token) if len(token) <= LEAF_BYTES else 0):
                if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None:
                    pairs[a << 32 | b] = rank
        keys = sorted(pairs)
        self.pairs = np.array([*keys, (1 << 63) - 1], dtype=np.int64)
        self.pair_ranks = np.array([*map(pairs.__getitem__, keys), NEVER], dtype=np.int32)
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _merge(self, data: bytes) -> list[bytes]:
        """Merge the two neighbours of lowest rank, the leftmost first, until none is in the vocabulary.

        Every two neighbours' rank is kept; a merge asks anew for the two it changes only.
        """
        rank = self.ranks.get
        cuts = [*range(len(data) + 1)]
        ranks = [rank(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
        while (best := min(ranks, default=NEVER)) < NEVER:
            at = ranks.index(best)
            del cuts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(data[cuts[at - 1] : cuts[at + 1]], NEVER)
            if at < len(ranks):
                ranks[at] = rank(data[cuts[at] : cuts[at + 2]], NEVER)
        return [data[a:b] for a, b in pairwise(cuts)]

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each two neighbours' merge, given by their own ranks; -1 stands for no neighbour."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], np.int32(NEVER))

    def _merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of many pieces of at most LEAF_BYTES bytes: in a round, each piece that is not done makes one merge."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        filled = np.arange(sizes.max() + 1) < sizes[:, None]
        tokens = np.full(filled.shape, -1, dtype=np.int32)
        tokens[filled] = self.byte_ranks[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        if tokens[filled].min() < 0:
            raise ValueError("the vocabulary lacks a byte")
        ranks = self._ranks_of(tokens[:, :-1], tokens[:, 1:])
        out, rows = np.full(tokens.shape, -1, dtype="<i4"), np.arange(len(pieces))
        while True:
            best = ranks.argmin(axis=1)  # the leftmost of equal ones
            rank = ranks[np.arange(len(rows)), best]
            open_ = rank < NEVER
            out[rows[~open_], : tokens.shape[1]] = tokens[~open_]
            if not open_.any():
                break
            rows, best, rank, tokens, ranks = rows[open_], best[open_, None], rank[open_, None], tokens[open_], ranks[open_]
            # A column less: the right one of the two goes, as does the rank between them. The last column is empty.
            column = np.arange(tokens.shape[1] - 1)
            np.put_along_axis(tokens, best, rank, axis=1)
            tokens = np.take_along_axis(tokens, column + (column > best), axis=1)
            ranks = np.take_along_axis(ranks, column[:-1] + (column[:-1] >= best), axis=1)
            after = np.minimum(best + 1, tokens.shape[1] - 1)
            before = np.maximum(best - 1, 0)
            here = np.take_along_axis(tokens, best, axis=1)
            np.put_along_axis(ranks, best, self._ranks_of(here, np.take_along_axis(tokens, after, axis=1)), axis=1)
            left = self._ranks_of(np.take_along_axis(tokens, before, axis=1), here)
            np.put_along_axis(ranks, before, np.where(best > 0, left, np.take_along_axis(ranks, before, axis=1)), axis=1)
        kept_ = out >= 0
        raw = out[kept_].tobytes()
        ends = (4 * np.cumsum(kept_.sum(axis=1))).tolist()
        return [raw[a:b] for a, b in pairwise([0, *ends])]

    def _merge_long(self, data: bytes) -> list[bytes]:
        """The same for long data: neighbours wait in a heap, spans are linked left and right."""
        n, rank = len(data), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := rank(data[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

        heap: list[tuple[int, int, int, int]] = []
        for i in range(n - 1):
            offer(i)
        gone = bytearray(n)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if gone[i] or end[i] != j or gone[j] or end[j] != stop:
                continue
            gone[j], end[i] = 1, stop
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [data[i : end[i]] for i in range(n) if not gone[i]]

    def _plain(self, data: bytes) -> list[bytes]:
        return self._merge(data) if len(data) <= 2 * LEAF_BYTES else self._merge_long(data)

    def _join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self._plain(b"".join(left[len(left) - i :] + right[:j]))
            left_stays = i == len(left) or self._plain(left[-i - 1] + window[0]) == [left[-i - 1], window[0]]
            right_stays = j == len(right) or self._plain(window[-1] + right[j]) == [window[-1], right[j]]
            if left_stays and right_stays:
                return left[: len(left) - i] + window + right[j:]
            i, j = (i if left_stays else 2 * i), (j if right_stays else 2 * j)

    def _tree(self, data: bytes) -> list[bytes]:
        if len(data) <= LEAF_BYTES:
            return self._plain(data)
        half = len(data) // 2
        return self._join(self._tree(data[:half]), self._tree(data[half:]))

    def _ids(self, piece: str) -> bytes:
        data = piece.encode()
        found = [data] if data in self.ranks else self._tree(data)
        return struct.pack(f"<{len(found)}I", *map(self.ranks.__getitem__, found))

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece) or self.chunks.get(piece)
        if known is None:
            known = self._ids(piece)
            if len(self.pieces) >= CACHE_PIECES:
                self.pieces.clear()
            self.pieces[piece] = known
        return known

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        data = [*map(str.encode, pieces)]
        short = [i for i, x in enumerate(data) if len(x) <= LEAF_BYTES and x not in self.ranks]
        merged = dict(zip(short, self._merge_many([data[i] for i in short]))) if short else {}
        return [merged.get(i) or self._ids(x) for i, x in enumerate(pieces)]

    def _leaves(self, texts: list[str]) -> list[bytes]:
        """Ids of each text: every chunk is looked up once, the gaps are filled after all new chunks are learned."""
        cut = [independent_chunks(t) for t in texts]
        chunks = [*chain.from_iterable(filter(None, cut))]
        found = [*map(self.chunks.get, chunks)]
        if None in found:
            gaps = [*compress(count(), map(not_, found))]  # a chunk has one id at least
            self._learn({*map(chunks.__getitem__, gaps)})
            for i in gaps:
                found[i] = self.chunks[chunks[i]]
        out, at = [], 0
        for text, own in zip(texts, cut):
            if own is None:
                out.append(b"".join(map(self._piece, self.split(text))))
            else:
                out.append(b"".join(found[at : at + len(own)]))
                at += len(own)
        return out

    def _learn(self, missing: set[str]) -> None:
        """Put chunks that the cache lacks into it. A chunk of one piece is kept among the chunks alone."""
        if len(self.chunks) + len(missing) > CACHE_ENTRIES:
            self.chunks.clear()
        if len(self.pieces) >= CACHE_PIECES:
            self.pieces.clear()
        split = dict(zip(missing, map(self.split, missing)))
        single = [c for c, pieces in split.items() if len(pieces) == 1]
        split = {c: pieces for c, pieces in split.items() if len(pieces) > 1}
        met = {c: self.pieces.pop(c) for c in single if c in self.pieces}
        new = [c for c in single if c not in met]
        parts = [p for p in {*chain.from_iterable(split.values())}.difference(single) if p not in self.pieces and p not in self.chunks]
        ids = self._ids_of([*new, *parts])
        self.chunks.update(met)
        self.chunks.update(zip(new, ids))
        self.pieces.update(zip(parts, ids[len(new) :]))
        for chunk, pieces in split.items():
            self.chunks[chunk] = b"".join([self.pieces.get(p) or self.chunks[p] for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        cut = _stable_cut(text, len(text) // 2) if len(text) > LEAF_CHARS else None
        if cut is None:
            return self._leaves([text])[0]
        return self.encode(text[:cut]) + self.encode(text[cut:])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """encode of each text; short ones go in runs."""
        out: list[bytes] = []
        run: list[str] = []
        size = 0
        for text in texts:
            if size + len(text) > RUN_CHARS or len(text) > LEAF_CHARS:
                out += self._leaves(run)
                run, size = [], 0
            if len(text) > LEAF_CHARS:
                out.append(self.encode(text))
            else:
                run.append(text)
                size += len(text)
        return out + self._leaves(run)

    def decode(self, ids: bytes) -> bytes:
        """The tokens' bytes, halves one after the other."""
        if len(ids) <= 4 * LEAF_CHARS:
            return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _stable_cut(text: str, middle: int) -> int | None:
    """A place near the middle where the pattern cuts for sure: the window around the middle grows until it has one."""
    reach = 64
    while True:
        lo, hi = max(1, middle - reach), min(len(text), middle + reach)
        for at in range(lo, hi):
            if text[at] in ASCII_SPACE and not text[at - 1].isspace():
                return at
        if lo == 1 and hi == len(text):
            return None
        reach *= 2


def encoder(path: str, pattern: str) -> BytePairs:
    """One encoder per worker process, so that its caches serve all batches."""
    return kept(("bpe", path, pattern), lambda: BytePairs(path, pattern))


def encode_documents(docs: DataFrame, *, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ids (binary, little-endian unsigned 32-bit integers) and decoded bytes of each row.

    path must be readable on all executors. Null counts as empty and has no ids; a special token's text is ordinary
    text; repeated rows stay; an empty table gives none; other columns are not read.
    """
    text_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ids = codec.encode_all([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.binary())], names=["id", "ids", "decoded"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {id_type.simpleString()}, ids binary, decoded binary").withColumnRenamed("id", id_col)


def token_digests(encoded: DataFrame, *keep: str, id_col: str = "doc_id") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of encode_documents' rows, after the columns to keep."""
    count = (F.octet_length("ids") / 4).cast("long")
    return encoded.select(id_col, *keep, count.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
