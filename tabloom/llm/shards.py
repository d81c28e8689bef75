"""Sharding by a k-d tree: nodes are cut at weighted medians along their widest dimension.

All nodes of a level are cut together. A cut is found by summing sizes per digit of an order key, ten bits at a time, so
at most 1,024 small rows a node reach the driver. The order key is the dimension's value followed by a hash of the row's
group, so that equal groups stand together and go to one side; a group is cut apart (by a hash of its ids) only where
keeping it whole would put more than a fiftieth of a shard on the wrong side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.native import numbered_within, whole
from tabloom.session import stash

DIGIT_BITS = 10
KEY_BITS = 60  # half for a dimension's value, half for the group
HALF = (1 << KEY_BITS // 2) - 1


@dataclass
class Node:
    """A box of rows that goes to the shards first .. first + shards - 1."""

    first: int
    shards: int
    cut: tuple[int, int, int] | None = None  # dimension, order key, hash of ids: larger rows go right
    sides: list["Node"] = field(default_factory=list)


def _leaf(node: Node) -> Column:
    """The first shard of the node that a row has come to, as far as the tree is cut."""
    if node.cut is None:
        return F.lit(node.first)
    dim, key, low = node.cut
    at = F.col(f"_key{dim}")
    left = (at < F.lit(key)) | ((at == F.lit(key)) & (F.col("_tie") <= F.lit(low)))
    return F.when(left, _leaf(node.sides[0])).otherwise(_leaf(node.sides[1]))


@dataclass
class Search:
    """Where the search for a node's cut stands: the digits found so far and the sizes below them."""

    node: Node
    dim: int
    want: int
    below: int = 0
    prefix: int = 0
    digits: int = 0
    key: int | None = None

    def digit(self) -> tuple[Column, Column]:
        """Which rows count, and the digit they count under."""
        value = F.col(f"_key{self.dim}") if self.key is None else F.col("_tie")
        which = F.col("_leaf") == self.node.first
        if self.key is not None:
            which &= F.col(f"_key{self.dim}") == F.lit(self.key)
        shift = KEY_BITS - DIGIT_BITS * (self.digits + 1)
        if self.digits:
            which &= F.shiftright(value, shift + DIGIT_BITS) == F.lit(self.prefix)
        return which, F.shiftright(value, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))

    def narrow(self, sums: list[tuple[int, int]], slack: int) -> bool:
        """Take the digit in which the wanted size is reached; true once the cut is known."""
        for digit, weight in sorted(sums):
            if self.below + weight >= self.want:
                break
            self.below += weight
        else:
            self.below -= weight
        self.prefix, self.digits = (self.prefix << DIGIT_BITS) | digit, self.digits + 1
        if self.digits * DIGIT_BITS < KEY_BITS:
            return False
        missing = self.want - self.below
        left = missing > weight / 2  # the nearer side gets the last group, or the last ids of a group
        if self.key is not None:
            self.node.cut = (self.dim, self.key, self.prefix if left else self.prefix - 1)
        elif min(missing, weight - missing) <= slack:
            self.node.cut = (self.dim, self.prefix, 1 << KEY_BITS if left else -1)
        else:
            self.key, self.prefix, self.digits = self.prefix, 0, 0
            return False
        return True


def _cut_level(rows: DataFrame, level: list[Node], dims: int, slack: int) -> None:
    """Cuts every node of a level; rows has _leaf, the place in the tree above the level."""
    ends = [0.1, 0.9]
    spreads = [F.percentile_approx(f"_key{k}", ends, 1000).alias(f"w{k}") for k in range(dims)]
    stats = {r["_leaf"]: r for r in rows.groupBy("_leaf").agg(F.sum("_size").alias("s"), *spreads).collect()}
    open_ = {}
    for n in level:
        half = n.shards // 2
        if n.first in stats:
            r = stats[n.first]
            widest = max(range(dims), key=lambda k: (r[f"w{k}"][1] - r[f"w{k}"][0], -k))
            open_[n.first] = Search(n, widest, r["s"] * half // n.shards)
        else:
            n.cut = (0, -1, -1)  # an empty box
        n.sides = [Node(n.first, half), Node(n.first + half, n.shards - half)]
    while open_:
        digits = {first: s.digit() for first, s in open_.items()}
        node = F.coalesce(*[F.when(which, F.lit(first)) for first, (which, _) in digits.items()])
        digit = F.coalesce(*[F.when(which, d) for which, d in digits.values()])
        sums: dict[int, list[tuple[int, int]]] = {}
        for r in rows.select(node.alias("n"), digit.alias("d"), "_size").filter("n IS NOT NULL").groupBy("n", "d").agg(F.sum("_size").alias("s")).collect():
            sums.setdefault(r["n"], []).append((r["d"], r["s"]))
        open_ = {first: s for first, s in open_.items() if not s.narrow(sums[first], slack)}


def kd_shards(df: DataFrame, *, id_col: str, size: Column, group: Column, dims: list[Column], shards: int, slack_share: float = 0.02) -> DataFrame:
    """df with _size and shard: shard sizes near equal, equal groups together as far as that allows.

    size: bytes of a row. group: a hash (long) of what must stay together. dims: numbers from 0 to 1, on comparable
    scales; null counts as 0, others are cut to that range. Ties are placed by the hashes, so a row's shard depends on
    the table's rows alone, not on their order; repeated rows (same id and group) go to the same shard. An empty table
    stays empty.
    """
    scaled = [F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.nanvl(d.cast("double"), F.lit(0.0)), F.lit(0.0)))) * HALF) for d in dims]
    keys = [F.shiftleft(v.cast("long"), KEY_BITS // 2).bitwiseOR(group.bitwiseAND(F.lit(HALF))).alias(f"_key{k}") for k, v in enumerate(scaled)]
    tie = F.xxhash64(F.col(id_col), group).bitwiseAND(F.lit((1 << KEY_BITS) - 1)).alias("_tie")
    rows = stash(df.select("*", size.cast("long").alias("_size"), *keys, tie))
    total = rows.agg(F.sum("_size")).first()[0] or 0
    root = Node(0, shards)
    level = [root] if shards > 1 else []
    while level:
        _cut_level(rows.withColumn("_leaf", _leaf(root)), level, len(dims), int(slack_share * total / shards))
        level = [x for n in level for x in n.sides if x.shards > 1]
    return rows.withColumn("shard", _leaf(root).cast("int")).drop("_tie", *[f"_key{k}" for k in range(len(dims))])


def shard_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 24) -> DataFrame:
    """One row per row of docs: id, size (UTF-8 bytes and 8), text_crc32, law, shard, slot, grown_shard.

    Dimensions of a document: the logarithm of its size, the share of its bytes beyond one a character, the density of
    its line breaks. All follow from the text, so copies of a text go together. A null text counts as empty; slots number
    a shard's rows without gaps, repeated rows included.
    """
    text = whole(F.col(text_col))
    size = F.octet_length(text).cast("long") + F.lit(8)
    narrow = docs.select(
        F.col(id_col).alias(id_col),
        size.alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("_text_hash"),
        (F.log2(size.cast("double")) / F.lit(40.0)).alias("_a"),
        ((F.octet_length(text) - F.length(text)) / size).alias("_b"),
        ((F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))) / size).alias("_c"),
    )
    placed = kd_shards(narrow, id_col=id_col, size=F.col("size"), group=F.col("_text_hash"), dims=[F.col("_a"), F.col("_b"), F.col("_c")], shards=shards)
    numbered = numbered_within(placed, "shard", [id_col, "_text_hash"], "slot")
    return numbered.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
