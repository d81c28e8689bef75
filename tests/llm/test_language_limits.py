"""Language ID with more labels than a mask has bits, and without any."""

from __future__ import annotations

import base64
import random
import tracemalloc

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from tabloom.llm import bpe, language


def test_more_than_64_languages(spark):
    rng = random.Random(6)
    words = {k: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(25)] for k in range(70)}
    rows = [(i, " ".join(rng.choice(words[i % 70]) for _ in range(40)), f"l{i % 70:02d}") for i in range(560)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.predict_languages(docs).join(docs.select(F.col("doc_id").alias("i"), "lang"), F.col("doc_id") == F.col("i")).collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 80 and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)


def test_labels_with_odd_names(spark):
    rows = [(k, "abc def" if k % 2 else "xyz uvw", 'q"uo\\te' if k % 2 else "") for k in range(40)]
    got = language.predict_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r["lang_pred"] == rows[r["doc_id"]][2] for r in got)


def test_stage_without_labels_keeps_texts_with_letters(spark):
    rows = [(1, "words here", None, "s", 10), (2, None, None, "s", 0), (3, "12 !!", None, "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, "").collect()] == [1]


def test_learning_takes_bounded_memory():
    rng = random.Random(8)
    text = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(text), pa.array(["a", "b"] * 1000)], names=["text", "lang"])
    tracemalloc.start()
    total = sum(sum(part.column(2).to_pylist()) for part in language.count_grams(iter([batch]), {"a": 0, "b": 1}))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == sum(len(t) - 1 for t in text)  # four-byte grams with a space before and after the text
    assert most < 64 << 20


def test_a_chunk_is_kept_once(tmp_path):
    (tmp_path / "ranks").write_text("".join(f"{base64.b64encode(bytes([k])).decode()} {k}\n" for k in range(256)))
    codec = bpe.BytePairs(str(tmp_path / "ranks"), r"\s?\w+|[^\s\w]+|\s+")
    assert codec.encode("one, two one two, one") == b"".join(bytes([c, 0, 0, 0]) for c in b"one, two one two, one")
    assert not set(codec.chunks) & set(codec.pieces) and " two" in codec.chunks and "," in codec.pieces


class Counted(dict):
    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


def test_a_merge_asks_for_changed_neighbours_only(tmp_path):
    tokens = [bytes([k]) for k in range(256)] + [b"a" * n for n in (2, 4, 8)]
    (tmp_path / "ranks").write_text("".join(f"{base64.b64encode(t).decode()} {k}\n" for k, t in enumerate(tokens)))
    codec = bpe.BytePairs(str(tmp_path / "ranks"), r"\s?\w+|[^\s\w]+|\s+")
    codec.ranks = Counted(codec.ranks)
    assert codec._plain(b"a" * 15) == [b"a" * 8, b"a" * 4, b"aa", b"a"]
    assert codec.ranks.asked <= 14 + 2 * 11


def test_pieces_merged_together_are_as_merged_alone(tmp_path):
    rng = random.Random(3)
    tokens = {bytes([k]) for k in range(256)} | {bytes(rng.choice(b"abc") for _ in range(n)) for n in (2, 2, 3, 3, 4, 5) for _ in range(12)}
    order = sorted(tokens, key=lambda t: (len(t) > 1, rng.random()))
    (tmp_path / "ranks").write_text("".join(f"{base64.b64encode(t).decode()} {k}\n" for k, t in enumerate(order)))
    codec = bpe.BytePairs(str(tmp_path / "ranks"), r"\s?\w+|[^\s\w]+|\s+")
    pieces = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 20))) for _ in range(3000)]
    want = [b"".join(codec.ranks[t].to_bytes(4, "little") for t in ([p.encode()] if p.encode() in codec.ranks else codec._merge_long(p.encode()))) for p in pieces]
    assert codec._ids_of(pieces) == want
    texts = [" ".join(rng.choices(pieces, k=rng.randrange(9))) + rng.choice(["", ",", "\x1c "]) for _ in range(400)] + ["", "ab " * 40_000]
    alone = bpe.BytePairs(str(tmp_path / "ranks"), r"\s?\w+|[^\s\w]+|\s+")
    assert codec.encode_all(texts) == [alone.encode(t) for t in texts]
