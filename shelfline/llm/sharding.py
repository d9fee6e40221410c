"""Sharding by a hierarchical weighted hash tree (region, rack, shard).

A row descends the tree: at every level each child draws ``-ln(u) / weight``
with ``u`` hashed from the row's key and the child's path, and the smallest draw
wins.  A child's draw does not depend on its siblings, so a changed weight moves
rows only into or out of the subtree whose weight changed.  A shard that is
added arrives as a region of its own, so it takes rows only into itself.

Everything is DataFrame expressions; the slot numbering shuffles rows by
(shard, band, cell) runs, never a whole shard to one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fraction, hash52, staged
from .ranks import cells_for, numbered, run_offsets

#: The first fleet: shards come in racks of 2 and regions of 4 racks.
SHARDS_PER_RACK, RACKS_PER_REGION = 2, 4
BANDS, ROWS_PER_RUN = 16, 200_000


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a shard carries its number, the others their children."""
    name: str
    weight: float = 1.0
    children: tuple["Node", ...] = field(default=())
    shard: int | None = None


def _branch(name: str, children: Sequence[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def fleet(shards: int, first: int = 24) -> Node:
    """The tree for a shard count: the ``first`` shards in full regions, each later one as a
    region of its own.  ``fleet(n + 1)`` therefore only adds a region to ``fleet(n)``."""
    leaf = lambda s: Node(f"s{s}", 1.0, shard=s)
    in_region = SHARDS_PER_RACK * RACKS_PER_REGION
    regions = []
    for lo in range(0, min(shards, first), in_region):
        members = [leaf(s) for s in range(lo, min(lo + in_region, shards, first))]
        racks = [_branch(f"k{i}", members[i:i + SHARDS_PER_RACK]) for i in range(0, len(members), SHARDS_PER_RACK)]
        regions.append(_branch(f"r{lo}", racks))
    regions += [_branch(f"r{s}", [_branch("k0", [leaf(s)])]) for s in range(first, shards)]
    return _branch("", regions)


def draw(key: Column, path: str, weight: float) -> Column:
    return -F.ln(fraction(F.concat(F.lit(path + "|"), key))) / F.lit(float(weight))


def _winner(key: Column, node: Node, path: str) -> Column:
    """Position of the child with the smallest draw (the lower position on a tie)."""
    if len(node.children) == 1:
        return F.lit(0)
    draws = [F.struct(draw(key, f"{path}/{c.name}", c.weight), F.lit(i).alias("i"))
             for i, c in enumerate(node.children)]
    return F.array_min(F.array(*draws))["i"]


def shard_of(key: Column, node: Node, path: str = "") -> Column:
    """Shard number of ``key``: draws are evaluated only along the path taken."""
    if node.shard is not None:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(key, node.children[0], f"{path}/{node.children[0].name}")
    at = _winner(key, node, path)
    picked = None
    for i, child in enumerate(node.children[:-1]):
        branch = shard_of(key, child, f"{path}/{child.name}")
        picked = F.when(at == i, branch) if picked is None else picked.when(at == i, branch)
    last = node.children[-1]
    return picked.otherwise(shard_of(key, last, f"{path}/{last.name}"))


def shard_rows(rows: DataFrame, tree: Node, id_column: str = "doc_id", shard: str = "shard",
               grown: Node | None = None, grown_shard: str = "grown_shard") -> DataFrame:
    """``rows`` with the shard of their id (and the one under a ``grown`` tree).

    A null id is a key of its own; repeated ids share a shard.  Columns of these
    names in the input are replaced.
    """
    key = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    rows = rows.withColumn(shard, shard_of(key, tree).cast("int"))
    if grown is not None:
        rows = rows.withColumn(grown_shard, shard_of(key, grown).cast("int"))
    return rows


def with_slots(rows: DataFrame, count: int, id_column: str = "doc_id", shard: str = "shard",
               tie: Sequence[Column] = (), slot: str = "slot") -> DataFrame:
    """Gapless slot of each row in its shard, from 0, by hashed id and then id and ``tie``.

    ``count`` (the number of rows) sets how finely shards are cut into runs.
    """
    key = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    cells = cells_for(count, 4, ROWS_PER_RUN * BANDS * 24)
    at = hash52(F.concat(F.lit("slot|"), key))
    keyed = (rows.withColumn("__band", F.pmod(at, F.lit(BANDS)).cast("int"))
             .withColumn("__cell", F.pmod(F.floor(at / F.lit(BANDS)).cast("bigint"), F.lit(cells)).cast("int")))
    runs = keyed.groupBy(shard, "__band", "__cell").agg(F.count(F.lit(1)).alias("n"))
    offsets = staged(run_offsets(runs, shard, "__band", "__cell"), "slots")
    order = [F.col(id_column).asc_nulls_last(), *tie]
    return numbered(keyed, offsets, shard, "__band", "__cell", order, slot).drop("__band", "__cell")


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per document: its size, checksum, shard and slot, and its shard in a fleet of
    one more (law ``key``).

    A null or empty text has size 8 and checksum 0; a null id is one key; repeated rows
    get slots of their own; an empty table gives no rows; other columns are not read.
    """
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    sized = docs.select("doc_id", (F.octet_length(raw) + 8).cast("bigint").alias("size"),
                        F.crc32(raw).alias("text_crc32"))
    sized = staged(shard_rows(sized, fleet(shards), grown=fleet(shards + 1)), "shards")
    slots = with_slots(sized, sized.count(), tie=[F.col("text_crc32"), F.col("size")])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
