"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level the key draws once per child; the draw is an exponential with the child's weight as
its rate, so a child wins in proportion to its weight, and changing one weight moves keys only into
or out of that child's subtree. An inner node's weight is the sum of its shards' weights.

A null key is a key like any other, so all rows without a key go to one shard; equal keys, hence repeated
rows, go to one shard and have a slot each; ties between draws go to the first child. Texts are not read. An
empty table gives no rows. Columns named like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import numbered


@dataclass(frozen=True)
class Node:
    """A shard (with a number) or an inner node (with children)."""

    name: str
    weight: float
    shard: int | None = None
    children: tuple[Node, ...] = ()


def branch(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), None, tuple(children))


def tree(shards: int, per_rack: int = 4, racks: int = 2, weights: dict[int, float] | None = None) -> Node:
    """A tree over shards 0 to ``shards`` - 1, dealt in order to racks and racks to regions."""
    if shards < 1:
        raise ValueError("at least one shard")
    leaves = [Node(f"shard{i}", (weights or {}).get(i, 1.0), i) for i in range(shards)]
    rows = [branch(f"rack{i}", leaves[i : i + per_rack]) for i in range(0, shards, per_rack)]
    return branch("root", [branch(f"region{i}", rows[i : i + racks]) for i in range(0, len(rows), racks)])


def grow(root: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region of its own: no other subtree's weight changes, so keys move
    only into the new shard."""
    number = 1 + max(leaf.shard for leaf in shards_of(root))
    added = branch(f"new-region{number}", [branch(f"new-rack{number}", [Node(f"shard{number}", weight, number)])])
    return branch(root.name, [*root.children, added])


def shards_of(node: Node) -> list[Node]:
    return [node] if node.shard is not None else [leaf for c in node.children for leaf in shards_of(c)]


def _draw(key: Column, node: Node) -> Column:
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11) + F.lit(0.5)) / F.lit(2.0**53)
    return -F.log(uniform) / F.lit(node.weight)


def place(key: Column, node: Node) -> Column:
    """The shard number that ``key`` reaches from ``node``."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if len(live) == 1:
        return place(key, live[0])
    draws = F.array(*[F.struct(_draw(key, c).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(live)])
    chosen = F.array_min(draws)["child"]
    out = place(key, live[-1])
    if all(c.shard is not None for c in live):
        return F.element_at(F.array(*[F.lit(c.shard) for c in live]), chosen + 1)
    for i, child in enumerate(live[:-1]):
        out = F.when(chosen == i, place(key, child)).otherwise(out)
    return out


def shard(df: DataFrame, key: str, root: Node, slots: bool = True) -> DataFrame:
    """Add ``shard``, ``grown_shard`` (with one more shard of weight 1) and, with ``slots``, the
    row's ``slot`` in its shard, from 0 without gaps. Other columns stay."""
    out = df.withColumns({"shard": place(F.col(key), root), "grown_shard": place(F.col(key), grow(root))})
    return numbered(out, ["shard"], "slot")[0] if slots else out
