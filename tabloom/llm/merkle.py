"""A Merkle manifest of a table of documents, leaf places by bitmap rank.

Each language has a tree. Its ids are a compressed bitmap: words of 64 ids, merged over all parts of the table by a
bitwise or; words without an id are not stored. A popcount directory says how many rows stand before each word, summed
over a few levels of the id's digits, so that no rows are sorted and no group of the directory grows with the table. The
rank of an id, rows before its word plus the bits below its own, is the place of its leaf.

Places key slot arrays: 64 nodes of a tree, each in the slot its place says, become one node six levels up. Arrays are
reduced until each tree is one node, and the roots of the trees are one more tree. On the way down each array hands its
members the siblings on their way to the root, so a path is built once per array, not once per leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.operators.ordered import number_rows
from tabloom.session import small_side, stash

WORD_BITS = 6
# Bits of a word's number that each level of the directory counts over, from the words up; the rest is the top level's.
DIRECTORY_BITS = (10, 16, 16)
LEVELS = 6
SLOTS = 1 << LEVELS
TIE_BLOCK_ROWS = 200_000
NULL_ID = -(1 << 63)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field_text, values)), 256)


def levels_of(nodes: list[str], n: int) -> list[list[str]]:
    """The nodes of one slot array level by level; n nodes has the tree on the array's first level."""
    out = [nodes]
    for _ in range(LEVELS if n > SLOTS else (n - 1).bit_length()):
        last = out[-1]
        out.append([digest("".join(last[k : k + 2])) for k in range(0, len(last), 2)])
    return out


def siblings(levels: list[list[str]], slot: int) -> Iterator[str]:
    """Sibling of a slot's node on each level of its array: side and digest, or - where it has none."""
    for nodes in levels[:-1]:
        other = slot ^ 1
        yield ("L" if other < slot else "R") + nodes[other] if other < len(nodes) else "-"
        slot >>= 1


def path_steps(path: str) -> list[str]:
    out, at = [], 0
    while at < len(path):
        size = 1 if path[at] == "-" else 65
        out.append(path[at : at + size])
        at += size
    return out


def fold(node: str, steps: list[str]) -> str:
    """The root that a node and its siblings lead to."""
    for step in steps:
        node = digest(step[1:] + node if step[0] == "L" else node + step[1:] if step[0] == "R" else node)
    return node


def in_slots(kids: list[dict], first: int, name: str) -> list:
    out = [None] * len(kids)
    for kid in kids:
        out[kid["at"] - first] = kid[name]
    return out


def _arrays(nodes: DataFrame, *columns: str) -> DataFrame:
    """(tree, n, array, kids): nodes of a tree by the slot array they stand in, at most 64."""
    key = F.shiftright("at", LEVELS).alias("array")
    return nodes.groupBy("tree", "n", key).agg(F.collect_list(F.struct("at", *columns)).alias("kids"))


def _reduced(arrays: DataFrame, name: str) -> DataFrame:
    """(tree, at, n, digest): the node that each array becomes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            made = [levels_of(in_slots(r["kids"], r["array"] << LEVELS, name), r["n"])[-1][0] for r in rows]
            columns = [batch.column(0), batch.column(2), pa.array([-(-r["n"] // SLOTS) for r in rows], pa.int64()), pa.array(made, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "at", "n", "digest"])

    return arrays.select("tree", "n", "array", "kids").mapInArrow(run, "tree string, at long, n long, digest string")


def _with_paths(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes (tree, at, n, digest) as (tree, at, path) with the siblings up to their trees' roots, and (tree, root)."""
    tiers = [stash(_arrays(nodes, "digest"))]
    upper = stash(_reduced(tiers[0], "digest"))
    while not upper.filter("n > 1").isEmpty():
        tiers.append(stash(_arrays(upper, "digest")))
        upper = stash(_reduced(tiers[-1], "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, at, path = [], [], []
            for r in batch.to_pylist():
                levels = levels_of(in_slots(r["kids"], r["array"] << LEVELS, "digest"), r["n"])
                for slot in range(len(r["kids"])):
                    tree.append(r["tree"])
                    at.append((r["array"] << LEVELS) + slot)
                    path.append("".join(siblings(levels, slot)) + r["path"])
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.string()), pa.array(at, pa.int64()), pa.array(path, pa.string())], names=["tree", "at", "path"])

    paths = upper.select("tree", "at", F.lit("").alias("path"))
    for arrays in reversed(tiers):
        above = paths.select(F.col("tree").alias("_tree"), F.col("at").alias("_array"), "path")
        met = arrays.join(above, (F.col("tree") == F.col("_tree")) & (F.col("array") == F.col("_array")))
        paths = stash(met.select("tree", "n", "array", "kids", "path").mapInArrow(run, "tree string, at long, path string"))
    return paths, upper.select("tree", F.col("digest").alias("root"))


def _running(order: list[str], group: list[str], size: str) -> Column:
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(before), F.lit(0))


def bitmap_directory(rows: DataFrame) -> DataFrame:
    """(tree, word, bits, rows, before): the bitmap of each tree's ids and how many rows stand before each word.

    A level's windows hold at most 2 to the DIRECTORY_BITS rows, the top level's 2 to the 16; the level above says where
    each window begins.
    """
    bit = F.expr(f"shiftleft(1L, cast(id & {(1 << WORD_BITS) - 1} as int))")
    words = stash(rows.groupBy("tree", F.shiftright("id", WORD_BITS).alias("word")).agg(F.bit_or(bit).alias("bits"), F.count("*").alias("rows")))
    tables = [words]
    for bits in DIRECTORY_BITS:
        tables[-1] = tables[-1].withColumn("up", F.shiftright("word", bits))
        tables.append(tables[-1].groupBy("tree", F.col("up").alias("word")).agg(F.sum("rows").alias("rows")))
    found = None
    for table in reversed(tables):
        table = table.withColumn("before", _running(["word"], ["tree", "up"] if found is not None else ["tree"], "rows"))
        if found is not None:
            above = found.select(F.col("tree").alias("_tree"), F.col("word").alias("_word"), F.col("before").alias("_before"))
            table = table.join(above, (F.col("tree") == F.col("_tree")) & (F.col("up") == F.col("_word")))
            table = table.withColumn("before", F.col("before") + F.col("_before")).drop("_tree", "_word", "_before")
        found = table
    return found.drop("up")


def _tied_places(rows: DataFrame, repeated: DataFrame, block_rows: int) -> DataFrame:
    """rows of words with repeated ids, with at: by id, then by leaf; equal leaves in any order.

    Rows of an id are counted by the first digits of their leaves, and equal ones in blocks of bounded size, so an id
    that a third of all rows have is not one task.
    """
    odd = repeated.select(F.col("tree").alias("_tree"), F.col("word").alias("_word"), F.col("before").alias("_before"))
    known = rows.join(odd, (F.col("tree") == F.col("_tree")) & (F.col("word") == F.col("_word")))
    known = stash(known.select(*rows.columns, "_before"))
    blocks = known.count() // block_rows + 8
    known = known.withColumns({"_bin": F.substring("leaf", 1, 3), "_block": F.pmod(F.xxhash64("row"), F.lit(blocks))})
    key = ["tree", "word", "id"]
    sizes = stash(known.groupBy(*key, "_before", "_bin", "leaf", "_block").agg(F.count("*").alias("_rows")))
    inner = sizes.withColumn("_in_bin", _running(["leaf", "_block"], [*key, "_bin"], "_rows"))
    bins = sizes.groupBy(*key, "_before", "_bin").agg(F.sum("_rows").alias("_rows")).withColumn("_in_id", _running(["_bin"], key, "_rows"))
    ids = bins.groupBy(*key, "_before").agg(F.sum("_rows").alias("_rows")).withColumn("_in_word", F.col("_before") + _running(["id"], ["tree", "word"], "_rows"))
    starts = inner.join(bins.select(*key, "_bin", "_in_id"), [*key, "_bin"]).join(ids.select(*key, "_in_word"), key)
    starts = starts.select(F.col("leaf").alias("_leaf"), F.col("_block").alias("_own"), (F.col("_in_bin") + F.col("_in_id") + F.col("_in_word")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("leaf", "_block").orderBy("row")) - 1
    placed = known.withColumn("_place", place).join(starts, (F.col("leaf") == F.col("_leaf")) & (F.col("_block") == F.col("_own")))
    return placed.withColumn("at", F.col("_start") + F.col("_place")).select(*rows.columns, "at")


def leaf_places(rows: DataFrame, *, tie_block_rows: int = TIE_BLOCK_ROWS) -> DataFrame:
    """rows (tree, id, leaf, row, ...) with word and at, the rank of each among its tree's rows by id, gapless from 0."""
    rows = rows.withColumn("word", F.shiftright("id", WORD_BITS))
    words = stash(bitmap_directory(rows))
    repeats = F.col("rows") > F.bit_count("bits")
    single = words.filter(~repeats).select(F.col("tree").alias("_tree"), F.col("word").alias("_word"), "bits", "before")
    below = F.expr(f"bit_count(bits & ~shiftleft(-1L, cast(id & {(1 << WORD_BITS) - 1} as int)))")
    met = rows.join(single, (F.col("tree") == F.col("_tree")) & (F.col("word") == F.col("_word")))
    placed = met.withColumn("at", F.col("before") + below).select(*rows.columns, "at")
    repeated = words.filter(repeats)
    if repeated.isEmpty():
        return placed
    return placed.unionByName(_tied_places(rows, small_side(repeated), tie_block_rows))


def manifest(
    docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "lang", size_col: str = "n_chars", field_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), tamper_every: int = 7, tie_block_rows: int = TIE_BLOCK_ROWS
) -> DataFrame:
    """One row per row of docs: id, leaf, subroot of its language, root, proof_sha256, folded_root, verified.

    Leaves of a language stand by ascending id, null as the least 64-bit integer; repeated ids by their leaves, and rows equal in all
    fields in any order. Null is a language of its own, the first. Where the unsigned crc32 of the decimal id divides by
    tamper_every, folded_root starts from a leaf with size_col raised by one (null sizes and null ids stay), so
    verified is false; everywhere else it starts from the leaf itself. Each folded root is computed from the leaf and
    its siblings. Other columns of docs play no part. An empty table gives none.
    """
    fields = {c: F.col(c) for c in field_cols}
    raised = fields | {size_col: F.col(size_col).cast("decimal(20,0)") + 1}
    hit = (F.crc32(F.col(id_col).cast("string").cast("binary")) % tamper_every == 0) & F.col(size_col).isNotNull()
    leaves = stash(
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(group_col)), F.lit("-")).alias("tree"),
            F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
            F.col(id_col).alias("given"),
            leaf_digest(*fields.values()).alias("leaf"),
            F.when(hit, leaf_digest(*raised.values())).alias("tampered"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    # One row per language; ordered by ranges, as nothing bounds their number.
    trees = stash(number_rows(leaves.groupBy("tree").agg(F.count("*").alias("n")), ["tree"], name="place"))
    sizes = small_side(trees.select(F.col("tree").alias("_of"), "n"))
    placed = leaf_places(leaves, tie_block_rows=tie_block_rows).join(sizes, F.col("tree") == F.col("_of"))
    arrays = stash(_arrays(placed, "given", "leaf", "tampered"))
    paths, subroots = _with_paths(_reduced(arrays, "leaf"))
    top = stash(trees.join(subroots.select(F.col("tree").alias("_of"), F.col("root").alias("subroot")), F.col("tree") == F.col("_of")).select("tree", "place", "subroot"))
    count = top.count()
    crown = top.select(F.lit("").alias("tree"), F.col("place").alias("at"), F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest"))
    crown_paths, roots = _with_paths(crown)
    ends = top.join(crown_paths.select("at", F.col("path").alias("last")), F.col("place") == F.col("at")).select(F.col("tree").alias("_top"), "subroot", "last")
    ends = ends.withColumn("root", F.lit(roots.first()["root"] if count else ""))
    given = leaves.schema["given"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")}
            for r in batch.to_pylist():
                first = r["array"] << LEVELS
                nodes = in_slots(r["kids"], first, "leaf")
                levels = levels_of(nodes, r["n"])
                above = path_steps(r["path"] + r["last"])
                up, ends_at = "".join(s[1:] for s in above), {}
                for kid in r["kids"]:
                    own = list(siblings(levels, kid["at"] - first))
                    node = fold(kid["tampered"] or kid["leaf"], own)
                    if node not in ends_at:
                        ends_at[node] = fold(node, above)
                    values = (kid["given"], kid["leaf"], r["subroot"], r["root"], digest("".join(s[1:] for s in own) + up), ends_at[node])
                    for column, value in zip(out.values(), values):
                        column.append(value)
            kinds = [batch.schema.field("kids").type.value_type.field("given").type, *[pa.string()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(out.values(), kinds)], names=list(out))

    up = paths.select(F.col("tree").alias("_tree"), F.col("at").alias("_array"), "path")
    met = arrays.join(up, (F.col("tree") == F.col("_tree")) & (F.col("array") == F.col("_array"))).join(small_side(ends), F.col("tree") == F.col("_top"))
    told = met.select("tree", "n", "array", "kids", "path", "last", "subroot", "root").mapInArrow(run, f"doc_id {given}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return told.select(F.col("doc_id").alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
