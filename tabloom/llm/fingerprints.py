"""Document fingerprints: the k smallest hashes of a text's word shingles.

Two sketches merge to the sketch of the union; the share of common hashes among the k smallest of the union estimates
resemblance, and the k-th smallest hash the number of distinct shingles. Built-in column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.llm.native import WHITE_SPACE, bound_once, id_blocks, whole

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
HASHES = 2.0**64


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Hashes of all runs of so many words; a shorter text is one run, an empty one has none."""
    word_hashes = F.transform(F.filter(F.split(text, WHITE_SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - F.lit(words)), lambda i: F.xxhash64(*[F.get(h, i + F.lit(j)) for j in range(words)]))
        few = F.array(F.xxhash64(h))
        none = F.expr("cast(array() as array<bigint>)")
        return F.when(F.size(h) >= words, many).when(F.size(h) > 0, few).otherwise(none)

    return bound_once(word_hashes, runs)


def smallest(hashes: Column, size: int = SKETCH_SIZE) -> Column:
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, size)


def sketch(text: Column, *, words: int = SHINGLE_WORDS, size: int = SKETCH_SIZE) -> Column:
    """Bottom-k sketch of a text; null counts as empty, whose sketch is empty."""
    return smallest(shingle_hashes(whole(text), words), size)


def merged(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    return smallest(F.array_union(a, b), size)


def distinct_shingles(s: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    share = (F.element_at(s, size).cast("double") + F.lit(HASHES / 2)) / F.lit(HASHES)
    return F.when(F.size(s) < size, F.size(s).cast("double")).otherwise(F.lit(float(size - 1)) / share)


def resemblance(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated Jaccard similarity. Two empty sketches are alike (1), an empty one is unlike any other (0)."""
    both = bound_once(merged(a, b, size), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both)


def containment(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated share of a's shingles that b has: resemblance times the union's size over a's. Empty a: 1."""
    share = resemblance(a, b, size) * distinct_shingles(merged(a, b, size), size) / distinct_shingles(a, size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def merge_sketches(df: DataFrame, by: list[str], sketch_col: str, *, size: int = SKETCH_SIZE, parts: int = 64) -> DataFrame:
    """One sketch per group of parts of a text collection.

    A hot group is first merged in parts. Hashes above a row's place can't be among the k smallest, so no array grows
    beyond k for each part.
    """
    def cut(rows: DataFrame, keys: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))
        return rows.dropDuplicates([*keys, "_hash"]).withColumn("_place", place).filter(F.col("_place") <= size).drop("_place")

    rows = df.select(*by, F.explode_outer(sketch_col).alias("_hash"))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("_hash"), F.lit(parts)))
    kept = cut(cut(dealt, [*by, "_part"]).drop("_part"), by)
    return kept.groupBy(*by).agg(F.array_sort(F.collect_list("_hash")).alias(sketch_col))


def as_text(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lower(F.hex(h))), ",")


def with_next(df: DataFrame, id_col: str, tie: str, columns: list[str], *, block_rows: int = 20_000) -> DataFrame:
    """Each row with `_next_` columns of the next row in descending id order; the last row gets the first one's.

    Rows are dealt to blocks of consecutive ids. The first row of each block is also copied to the block before it, so
    rows move once and no task orders the whole table.
    """
    # Block numbers fall as ids rise, so the block with the largest ids comes first; null ids come last.
    blocked = df.withColumn("_block", -id_blocks(df.select(id_col), id_col, block_rows))
    heads = blocked.groupBy("_block").agg(F.max(F.struct(F.col(id_col), F.col(tie))).alias("_head"))
    order = Window.orderBy("_block")  # one row per block
    last = Window.partitionBy(F.lit(0))
    heads = heads.withColumn("_before", F.coalesce(F.lag("_block").over(order), F.max("_block").over(last))).select(F.col("_block").alias("_own"), "_head", "_before")
    marked = blocked.join(F.broadcast(heads), F.col("_block") == F.col("_own"), "left")
    is_head = F.struct(F.col(id_col), F.col(tie)).eqNullSafe(F.col("_head"))
    real = marked.select(*df.columns, "_block", F.lit(0).alias("_copy"))
    copied = marked.filter(is_head).select(*df.columns, F.col("_before").alias("_block"), F.lit(1).alias("_copy"))
    within = Window.partitionBy("_block").orderBy("_copy", F.desc(id_col), F.desc(tie))
    ahead = real.union(copied).withColumns({f"_next_{c}": F.lead(c).over(within) for c in columns})
    return ahead.filter(F.col("_copy") == 0).drop("_block", "_copy")


def fingerprint_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SKETCH_SIZE) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with likenesses to the edited and the next text.

    The edited text ends in the first floor(n/3) code points of the next text (descending id) in place of as many of
    its own. Null texts count as empty; equal ids are ordered by a hash of their texts; a table of one row is its own next
    row; an empty table gives none. Other columns are not read.
    """
    text = whole(F.col(text_col))
    own = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_tie"))
    sketched = own.withColumn("_sketch", sketch(F.col("_text"), size=size))
    paired = with_next(sketched, "_id", "_tie", ["_text", "_sketch"])
    third = F.floor(F.length("_text") / 3).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), F.length("_text") - third), F.substring(F.col("_next__text"), F.lit(1), third))
    rows = paired.select("_id", F.length("_text").cast("long").alias("n_chars"), edited.alias("_edited"), "_sketch", "_next__sketch")
    rows = rows.withColumn("_edited_sketch", sketch(F.col("_edited"), size=size))
    return rows.select(
        F.col("_id").alias(id_col),
        "n_chars",
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("_sketch")).alias("fingerprint"),
        as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("_sketch"), F.col("_edited_sketch"), size).alias("near_edited"),
        resemblance(F.col("_sketch"), F.col("_next__sketch"), size).alias("near_next"),
        distinct_shingles(F.col("_sketch"), size).alias("n_shingles"),
        containment(F.col("_sketch"), F.col("_edited_sketch"), size).alias("kept_in_edited"),
    )
