"""Shards by a weighted hash tree over regions, racks and shards, in expressions only."""

from __future__ import annotations

from dataclasses import dataclass
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.llm.common import bucketed_rank


@dataclass(frozen=True)
class Node:
    """A region, a rack or a shard. A shard has a number; the weight of others is their shards'."""

    name: str
    shard: int | None = None
    own_weight: float = 1.0
    children: tuple[Node, ...] = ()

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.own_weight

    @property
    def nodes(self) -> list[Node]:
        return [self, *(found for child in self.children for found in child.nodes)]

    @property
    def depth(self) -> int:
        return 1 + max((child.depth for child in self.children), default=-1)


def grown_tree(shards: int, widths: tuple[int, int] = (2, 4)) -> Node:
    """The tree after ``shards`` shards of weight 1 joined one by one.

    ``widths`` are the racks of a region and the shards of a rack; full regions come first.
    """
    racks, size = widths
    regions = []
    for first in range(0, shards, prod(widths)):
        region = f"region{first // prod(widths)}"
        held = [
            Node(f"{region}/rack{k}", children=tuple(Node(f"shard{s}", s) for s in range(at, min(at + size, shards))))
            for k, at in enumerate(range(first, min(first + prod(widths), shards), size))
        ]
        regions.append(Node(region, children=tuple(held)))
    return Node("root", children=tuple(regions))


def _draw(key: Column, name: Column, weight: Column) -> Column:
    """An exponential arrival time with the weight as its rate: the earliest wins."""
    digits = F.substring(F.md5(F.concat(key, F.lit("@"), name)), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)
    return -F.log(uniform) / weight


def place(key: Column, tree: Node) -> Column:
    """The shard of a key: at each level the child with the earliest draw, down to a shard.

    A draw depends on the key, the child's name and its weight alone. When a shard joins or leaves,
    draws change only on its own path: rows move into (or out of) subtrees on it and stay
    elsewhere. A shard that opens a region takes rows only into itself. Names are those of the tree,
    whose size bounds the literals in the plan.
    """
    inner = [node for node in tree.nodes if node.children]
    if any(node.weight <= 0 for node in inner):
        raise ValueError("each region and rack needs weight")
    held = [pair for node in inner for pair in (F.lit(node.name), _children(node))]
    children = F.create_map(*held)
    shards = F.create_map(*[F.lit(v) for node in tree.nodes if node.shard is not None for v in (node.name, node.shard)])
    at = F.lit(tree.name)
    for _ in range(tree.depth):
        draws = F.transform(
            F.try_element_at(children, at), lambda c: F.struct(_draw(key, c["name"], c["weight"]), c["name"].alias("name"))
        )
        at = F.coalesce(F.array_min(draws)["name"], at)
    return F.element_at(shards, at)


def _children(node: Node) -> Column:
    open_children = [child for child in node.children if child.weight > 0]
    return F.array(*[F.struct(F.lit(c.name).alias("name"), F.lit(float(c.weight)).alias("weight")) for c in open_children])


def shard_rows(rows: DataFrame, tree: Node, grown: Node | None = None, key: str = "doc_id", text: str = "text"):
    """(key, size, text_crc32, shard, slot, grown_shard): one row per input row.

    ``shard`` is a function of the key and the tree, so equal keys share a shard and a null key
    counts as the word ``null``. ``slot`` numbers a shard's rows from 0 without gaps, by hash
    bucket of (key, size, checksum) and then by these, so that a key that repeats with other texts
    is spread over the buckets. ``size`` is the
    UTF-8 length plus 8, null texts having none. An empty table gives no rows; further columns
    are not read.

    The text is read once and never shuffled: counts per shard come from the key column alone,
    and ranks move (key, size, checksum) rows. A shard's rows are numbered in buckets of bounded
    size, so the work does not depend on the number of shards.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    body = F.coalesce(F.col(text), F.lit(""))
    placed = rows.select(
        F.col(key).alias("id"),
        (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        place(name, tree).alias("shard"),
        (place(name, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    counts = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    held = ["id", "size", "text_crc32"]
    ranked = bucketed_rank(placed, counts, "shard", F.xxhash64(*held), held, "slot")
    return ranked.select(F.col("id").alias(key), "size", "text_crc32", "shard", "slot", "grown_shard")
