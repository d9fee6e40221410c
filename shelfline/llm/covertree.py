"""Embedding near-duplicates by dual traversal of cover trees.

Vectors lie on the unit sphere, where cosine c is the distance sqrt(2 - 2c).  The
top of the tree is a net of anchors taken from a bounded sample; every vector
belongs to its nearest anchor's cell, and a cell is cut into blocks of bounded
size.  In each block nested levels of centres with halving radii are built (a
centre stays a centre on all finer levels).  Pairs of cells, then pairs of
nodes, are dropped when the distance of their centres exceeds the threshold plus
both covering radii; when it stays below the threshold less both radii, all their
pairs link at once and are counted, not listed; what remains is compared in
double precision.  Every pair at or above the threshold is found.

Blocks of near cells are bundled, and a pair of bundles is one group of a shuffle, so
the work is spread over the cluster and a task holds one block more than a bundle at a
time.  On data without structure in many dimensions the bounds prune single vectors
only, and the block pairs grow with the square of the table: that is the method's
nature; clustered data prune at the cell level.  There most node pairs are dropped by
their leading principal axes alone: the rest of a product is at most that of the
lengths left over.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import python_tasks, staged
from .components import connected_components

COSINE = 0.95
#: Bounds: vectors looked at for anchors, anchors, rows of a block.
SAMPLE, ANCHORS, LEAST_BLOCK, MOST_BLOCK = 4096, 256, 1024, 8192
#: Covering radii of the levels below a cell.
RADII = (1.0, 0.5, 0.25, 0.125, 0.0625)
#: Slack of the bounds against rounding.
EPS = 1e-7
#: Nodes on a side of a tile, and node pairs settled at a time.
TILE, BATCH = 512, 1 << 15
#: Leading axes of the first test of a tile, and the share of pairs up to which it settles the tile alone.
HEAD, FEW = 20, 1 / 64
#: Values of the vectors of a bundle, and the least bundles aimed at.
BUNDLE_VALUES, BUNDLES = 1 << 22, 16
#: Centres of a level that are compared with the rows at a time.
CENTRES = 256


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    scale = np.abs(x).max(axis=1, keepdims=True)  # keeps the squares in range
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector) -> bool:
    return vector is not None and len(vector) > 0 and all(v is not None for v in vector) \
        and bool(np.isfinite(np.asarray(vector, float)).all()) and bool(np.any(np.asarray(vector, float) != 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def net(x: np.ndarray, radius: float, most: int) -> np.ndarray:
    """Indices of greedy centres more than ``radius`` apart, ``most`` at most."""
    chosen: list[int] = []
    for i in range(len(x)):
        if not chosen or (distances(x[i:i + 1], x[chosen]) > radius).all():
            chosen.append(i)
            if len(chosen) == most:
                break
    return np.array(chosen, int)


def build_levels(x: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Order of the rows in which every node is a range, and (starts, centres, radii) per level.

    Centres are positions in that order; radii are the distances actually covered.
    """
    n = len(x)
    paths = np.zeros((n, len(RADII)), int)
    groups = [np.arange(n)]
    for level, radius in enumerate(RADII):
        finer = []
        for rows in groups:
            left = rows
            while len(left):  # the parent's centre comes first, so levels are nested
                if len(left) == 1:
                    paths[left, level] = left
                    finer.append(left)
                    break
                within = distances(x[left[:CENTRES]], x[left]) <= radius
                free = np.ones(len(left), bool)
                for i in range(len(within)):
                    if free[i]:
                        near = within[i] & free
                        near[i] = True
                        paths[left[near], level] = left[i]
                        finer.append(left[near])
                        free &= ~near
                left = left[free]
        groups = finer
    order = np.concatenate(groups)  # children of a node stand together, level by level
    levels = []
    for level in range(len(RADII)):
        centre_of = paths[order, level]
        starts = np.flatnonzero(np.r_[True, centre_of[1:] != centre_of[:-1]])
        place = np.empty(n, int)
        place[order] = np.arange(n)
        centres = place[centre_of[starts]]
        to_centre = np.sqrt(np.maximum(0.0, ((x[order] - x[centre_of]) ** 2).sum(axis=1)))
        levels.append((starts, centres, np.maximum.reduceat(to_centre, starts)))
    return order, levels


def pack_block(ids: np.ndarray, vectors: np.ndarray) -> bytes:
    order, levels = build_levels(unit(vectors))
    short = vectors.astype(np.float32)  # the usual source type, at half the bytes
    kept = short if (short == vectors).all() else vectors
    arrays = {"ids": ids[order], "x": kept[order]}
    for k, (starts, centres, radii) in enumerate(levels):
        up = np.nextafter(radii.astype(np.float32), np.float32(np.inf))  # half the bytes, never short of the radius
        arrays |= {f"s{k}": starts.astype(np.int32), f"c{k}": centres.astype(np.int32), f"r{k}": up}
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


class Block:
    """``axes``: orthonormal columns, the directions in which the vectors spread most first."""

    def __init__(self, raw: bytes, axes: np.ndarray | None = None):
        with np.load(io.BytesIO(raw)) as z:
            self.ids, self.x = z["ids"], unit(z["x"])
            self.short = self.x.astype(np.float32)
            self.levels = [(z[f"s{k}"].astype(np.int64), z[f"c{k}"].astype(np.int64), z[f"r{k}"].astype(float))
                           for k in range(len(RADII))]
        n, dim = self.x.shape
        self.ends = [np.r_[s[1:], n] for s, _, _ in self.levels]
        self.head = None
        if dim > HEAD + 1:
            lead = self.x[:, :HEAD] if axes is None else self.x @ axes[:, :HEAD]
            rest = np.sqrt(np.maximum(0.0, 1.0 - (lead * lead).sum(axis=1, keepdims=True)))
            self.head = np.hstack([lead, rest]).astype(np.float32)


class Links:
    """Counts per row and a forest of links over the rows of two blocks.

    ``start_a`` and ``start_b``: where the rows of the blocks begin in ``counts`` and ``parent``
    that several pairs of blocks share.
    """

    def __init__(self, a: Block, b: Block, start_a: int = 0, start_b: int | None = None,
                 counts: np.ndarray | None = None, parent: np.ndarray | None = None):
        self.a, self.b, self.same = a, b, a is b
        self.start = start_a
        self.offset = start_a if self.same else (start_a + len(a.ids) if start_b is None else start_b)
        n = self.offset + len(b.ids)
        self.counts = np.zeros(n, np.int64) if counts is None else counts
        self.parent = np.arange(n) if parent is None else parent

    def _root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def _join(self, i: int, j: int) -> None:
        i, j = self._root(i), self._root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)

    def all_pairs(self, ia: tuple[int, int], ib: tuple[int, int]) -> None:
        (a0, a1), (b0, b1) = ia, ib
        a0, a1 = a0 + self.start, a1 + self.start
        if self.same and ia == ib:
            self.counts[a0:a1] += a1 - a0 - 1
            for i in range(a0 + 1, a1):
                self._join(a0, i)
            return
        b0, b1 = b0 + self.offset, b1 + self.offset
        self.counts[a0:a1] += b1 - b0
        self.counts[b0:b1] += a1 - a0
        for i in range(a0, a1):
            self._join(i, b0)
        for i in range(b0, b1):
            self._join(a0, i)

    def pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        """Linked rows i of a and j of b, each pair once."""
        i, j = i + self.start, j + self.offset
        np.add.at(self.counts, i, 1)
        np.add.at(self.counts, j, 1)
        for p, q in zip(i.tolist(), j.tolist()):
            self._join(p, q)


def linked_rows(ids: np.ndarray, counts: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, links, id of the root of its tree) of the linked rows."""
    at = np.flatnonzero(counts)
    while True:
        above = parent[parent]
        if (above == parent).all():
            return ids[at], counts[at], ids[parent[at]]
        parent = above


class Traversal:
    """Dual traversal of the trees of two blocks (or of one with itself), many node pairs at a time.

    Wide fans of children are met in tiles of a single-precision product with the bounds
    loosened by its rounding: the squared sum of threshold and radii is a product itself, so
    one matrix product holds both sides of the test.  A tile takes the leading axes with the
    length of the rest, and whole vectors only where many pairs pass that.  Every pair that
    stays is settled in double precision.  Pairs are handled in batches of ``BATCH``, depth
    first, so memory does not follow the links.
    """

    def __init__(self, a: Block, b: Block, cosine: float, links: Links | None = None):
        self.a, self.b, self.cosine = a, b, cosine
        self.t = float(np.sqrt(2.0 - 2.0 * cosine))
        self.slack = 4e-6 + 2.4e-7 * a.x.shape[1]
        self.links = links or Links(a, b)

    def run(self) -> Links:
        # levels that hold hardly fewer nodes than the next would be met twice for nothing
        nodes = [len(sa) * len(sb) for (sa, _, _), (sb, _, _) in zip(self.a.levels, self.b.levels)]
        first = max(k for k, n in enumerate(nodes) if n <= 1.5 * nodes[0])
        self.tiles(first, (0, len(self.a.levels[first][0])), (0, len(self.b.levels[first][0])), self.links.same)
        return self.links

    def tiles(self, level: int, na: tuple[int, int], nb: tuple[int, int], own: bool) -> None:
        """All pairs of two node ranges of a level (each once if they are one range)."""
        least = np.float32(1.0 - self.slack)
        for i in range(na[0], na[1], TILE):
            rows = slice(i, min(i + TILE, na[1]))
            left = self.side(self.a, level, rows, True)
            for j in range(i if own else nb[0], nb[1], TILE):
                cols = slice(j, min(j + TILE, nb[1]))
                right = self.side(self.b, level, cols, False)
                near = left[0] @ right[0].T >= least
                if len(left) > 1 and np.count_nonzero(near) > FEW * near.size:
                    near &= left[1] @ right[1].T >= least
                at = np.flatnonzero(near)
                p, q = at // near.shape[1] + i, at % near.shape[1] + j
                if own:
                    p, q = p[p <= q], q[p <= q]
                for k in range(0, len(p), BATCH):
                    self.settle(level, p[k:k + BATCH], q[k:k + BATCH])

    def side(self, block: Block, level: int, nodes: slice, first: bool) -> list[np.ndarray]:
        """Centres of the nodes with the terms of the bound: centres d apart have the product
        1 - d * d / 2, and d may be the sum of u = threshold + radius of the one and v = radius of
        the other, so product + u * v + u * u / 2 + v * v / 2 is to reach 1."""
        _, centres, radii = block.levels[level]
        r, c = radii[nodes] + (self.t + EPS if first else 0.0), centres[nodes]
        one = np.ones(len(r))
        bound = np.stack([r, r * r / 2, one] if first else [r, one, r * r / 2], axis=1).astype(np.float32)
        both = self.a.head is not None and self.b.head is not None
        return [np.hstack([x[c], bound]) for x in ([block.head, block.short] if both else [block.short])]

    def settle(self, level: int, p: np.ndarray, q: np.ndarray) -> None:
        """Drop, link or descend into the pairs of nodes p of a and q of b."""
        a, b, links = self.a, self.b, self.links
        (sa, ca, ra), (sb, cb, rb) = a.levels[level], b.levels[level]
        product = np.einsum("ij,ij->i", a.x[ca[p]], b.x[cb[q]])
        d, reach = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * product)), ra[p] + rb[q]
        own = (p == q) if links.same else np.zeros(len(p), bool)
        near = own | (d <= self.t + reach + EPS)
        a0, a1, b0, b1 = sa[p], a.ends[level][p], sb[q], b.ends[level][q]
        one = (a1 - a0 == 1) & (b1 - b0 == 1)  # two single vectors
        linked = one & ~own & (product >= self.cosine)
        links.pairs(a0[linked], b0[linked])
        whole = near & ~one & (np.where(own, 2 * ra[p], d + reach) <= self.t - EPS)
        for k in np.flatnonzero(whole).tolist():
            links.all_pairs((int(a0[k]), int(a1[k])), (int(b0[k]), int(b1[k])))
        rest = np.flatnonzero(near & ~one & ~whole)
        if level + 1 < len(RADII):
            self.descend(level + 1, a0[rest], a1[rest], b0[rest], b1[rest], own[rest])
        else:
            for k in rest.tolist():
                _compare(links, (int(a0[k]), int(a1[k])), (int(b0[k]), int(b1[k])), self.cosine)

    def descend(self, level: int, a0, a1, b0, b1, own) -> None:
        """The pairs of child nodes of pairs of row ranges."""
        sa, sb = self.a.levels[level][0], self.b.levels[level][0]
        la, lb = np.searchsorted(sa, a0), np.searchsorted(sb, b0)
        wide, high = np.searchsorted(sa, a1) - la, np.searchsorted(sb, b1) - lb
        size = wide * high
        for k in np.flatnonzero(size > BATCH).tolist():
            self.tiles(level, (int(la[k]), int(la[k] + wide[k])), (int(lb[k]), int(lb[k] + high[k])), bool(own[k]))
        few = np.flatnonzero(size <= BATCH)
        batch = np.cumsum(size[few]) // BATCH
        for some in np.split(few, np.flatnonzero(np.diff(batch)) + 1):
            parent = np.repeat(some, size[some])
            at = np.arange(len(parent)) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
            p, q = la[parent] + at // high[parent], lb[parent] + at % high[parent]
            once = ~own[parent] | (p <= q)
            if once.any():
                self.settle(level, p[once], q[once])


def traverse(a: Block, b: Block, cosine: float = COSINE, links: Links | None = None) -> Links:
    return Traversal(a, b, cosine, links).run()


def _compare(links: Links, ia: tuple[int, int], ib: tuple[int, int], cosine: float) -> None:
    a, b = links.a.x[slice(*ia)], links.b.x[slice(*ib)]
    linked = a @ b.T >= cosine
    if links.same and ia == ib:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    links.pairs(i + ia[0], j + ib[0])


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding).

    Vectors that are null, empty or zero, hold a null or non-finite component, or have a null
    id link with nothing; only vectors of one length are compared; rows that repeat an id and
    its vector count once; other columns are not read; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    python_tasks(spark)
    rows = staged(embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
                  .dropDuplicates(["vec_id", "v"]), "vectors")
    fit = (F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
           & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
           & F.exists("v", lambda x: x != 0))
    good = rows.where(fit).withColumn("dim", F.size("v"))
    n = good.count()
    block_rows = int(min(MOST_BLOCK, max(LEAST_BLOCK, n // 32)))
    wanted = int(min(ANCHORS, max(1, n // (2 * block_rows))))
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("dim", "v").toPandas()
    anchors, axes = {}, {}
    for dim, some in sample.groupby("dim"):
        x = unit(np.stack(some["v"].to_numpy()))
        anchors[int(dim)] = x[net(x, RADII[0] / 2, wanted)]
        axes[int(dim)] = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :HEAD].copy()

    def assign(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            values = batch.column("v").flatten().to_numpy()
            starts = np.cumsum(dims, dtype=np.int64) - dims
            cell, reach = np.zeros(len(dims), np.int64), np.full(len(dims), 2.0)
            for dim in set(dims.tolist()) & anchors.keys():  # other lengths: one cell, cut into blocks like others
                at = np.flatnonzero(dims == dim)
                d = distances(unit(values[starts[at][:, None] + np.arange(dim)]), anchors[dim])
                cell[at], reach[at] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), batch.column("dim"), pa.array(cell), pa.array(reach)],
                names=["vec_id", "v", "dim", "cell", "reach"])

    celled = staged(good.select("vec_id", "v", "dim").mapInArrow(
        assign, "vec_id long, v array<double>, dim int, cell long, reach double"), "cells")
    cells = celled.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("rows"), F.max("reach").alias("reach"))
    cells = staged(cells.withColumn("blocks", F.ceil(F.col("rows") / F.lit(block_rows)).cast("int")), "cell-sizes")
    blocked = (celled.join(cells.select("dim", "cell", "blocks"), ["dim", "cell"])
               .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")))

    def pack(key, frame: pd.DataFrame) -> pd.DataFrame:
        raw = pack_block(frame["vec_id"].to_numpy(np.int64), np.stack(frame["v"].to_numpy()))
        return pd.DataFrame({"dim": [key[0]], "cell": [key[1]], "part": [key[2]], "raw": [raw]})

    blocks = staged(blocked.select("vec_id", "v", "dim", "cell", "part").groupBy("dim", "cell", "part")
                    .applyInPandas(pack, "dim int, cell long, part int, raw binary")
                    .withColumn("block", F.monotonically_increasing_id()), "blocks")
    few = cells.select("dim", "cell", "reach", "blocks").orderBy("dim", "cell").toPandas()
    order, near = _near_cells(few, anchors, cosine)
    tiles = _bundle_pairs(blocks, few, order, near, block_rows)

    def link(key, frame: pd.DataFrame) -> pd.DataFrame:
        side = {g: frame[frame["bundle"] == g].sort_values("block") for g in map(int, key[1:])}
        dim, i, j = map(int, key)
        rows, cols, reach, basis = side[i], side[j], near[dim], axes.get(dim)
        sizes, ids = {}, []
        for b, raw in zip(frame["block"], frame["raw"]):
            with np.load(io.BytesIO(raw)) as z:
                sizes[b] = (sum(map(len, ids)), len(z["ids"]))
                ids.append(z["ids"])
        ids = np.concatenate(ids)
        counts, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))
        held = [Block(raw, basis) for raw in rows["raw"]]
        for k, (b, cell, raw) in enumerate(zip(cols["block"], cols["cell"], cols["raw"])):
            y = held[k] if i == j else Block(raw, basis)
            for x, a, other in zip(held[:k + 1] if i == j else held, rows["block"], rows["cell"]):
                if (int(other), int(cell)) in reach:
                    traverse(x, y, cosine, Links(x, y, sizes[a][0], sizes[b][0], counts, parent))
        found_ids, n, roots = linked_rows(ids, counts, parent)
        return pd.DataFrame({"vec_id": found_ids, "n": n, "root": roots})

    found = staged(tiles.groupBy("dim", "i", "j").applyInPandas(link, "vec_id long, n long, root long"), "found")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    components = connected_components(found.where("vec_id <> root").distinct(), "vec_id", "root")
    result = (rows.select("vec_id", fit.alias("fit")).join(counts, "vec_id", "left")
              .join(components.withColumnRenamed("node", "vec_id"), "vec_id", "left"))
    return result.select(
        "vec_id", F.when(F.col("fit"), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("fit"), F.coalesce("component", "vec_id")).otherwise(F.col("vec_id")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _near_cells(cells: pd.DataFrame, anchors: dict[int, np.ndarray], cosine: float
                ) -> tuple[dict[int, list[int]], dict[int, set[tuple[int, int]]]]:
    """Of each length the cells in an order that keeps near ones together, and the pairs of cells that
    may hold a link.

    Cell pairs are tested against the covering radii on the driver: there are at most ANCHORS
    cells of a length.
    """
    t = float(np.sqrt(2.0 - 2.0 * cosine))
    order, near = {}, {}
    for dim, group in cells.groupby("dim"):
        cell, reach = group["cell"].to_numpy(), group["reach"].to_numpy()
        if int(dim) in anchors:
            x = anchors[int(dim)][cell]
            d = distances(x, x)
        else:
            d = np.zeros((len(cell), len(cell)))
        np.fill_diagonal(d, 0.0)
        p, q = np.nonzero(d <= t + reach[:, None] + reach[None, :] + EPS)
        near[int(dim)] = {(int(cell[i]), int(cell[j])) for i, j in zip(p, q)}
        walk, left = [0], list(range(1, len(cell)))
        while left:  # from each cell to the nearest one not met yet
            walk.append(left.pop(int(np.argmin(d[walk[-1], left]))))
        order[int(dim)] = [int(cell[i]) for i in walk]
    return order, near


def _bundle_pairs(blocks: DataFrame, cells: pd.DataFrame, order: dict[int, list[int]],
                  near: dict[int, set[tuple[int, int]]], block_rows: int) -> DataFrame:
    """(dim, i, j, bundle, block, cell, raw): the blocks of every pair i <= j of bundles whose cells may
    hold a link, once for each pair.

    Bundles are runs of blocks in the order of the cells, so a block is shuffled once for each bundle
    near it, not for each block.
    """
    spark = blocks.sparkSession
    held = {(int(d), int(c)): int(n) for d, c, n in zip(cells["dim"], cells["cell"], cells["blocks"])}
    widest = max((dim for dim, _ in held), default=1)
    each = max(1, min(sum(held.values()) // BUNDLES, BUNDLE_VALUES // (block_rows * widest)))
    start = {}
    for dim, walk in order.items():
        for cell, before in zip(walk, np.cumsum([0] + [held[dim, cell] for cell in walk]).tolist()):
            start[dim, cell] = before
    runs = {key: (first // each, (first + held[key] - 1) // each) for key, first in start.items()}
    starts = _local(spark, "dim int, cell long, start long", [(*key, first) for key, first in start.items()])
    ranges = {(dim, *runs[dim, a], *runs[dim, b]) for dim, some in near.items() for a, b in some}
    tiles = (_local(spark, "dim int, a long, b long, c long, d long", sorted(ranges))
             .select("dim", F.explode(F.sequence("a", "b")).alias("i"), "c", "d")
             .select("dim", "i", F.explode(F.sequence("c", "d")).alias("j")).where("i <= j").distinct())
    needs = tiles.select("dim", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("bundle"))
    return (blocks.join(F.broadcast(starts), ["dim", "cell"])
            .select("dim", F.floor((F.col("start") + F.col("part")) / each).cast("long").alias("bundle"), "cell", "block", "raw")
            .join(needs, ["dim", "bundle"]))


def _local(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small frame from the driver, without a Python job."""
    names = [c.split()[0] for c in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in names]
    table = pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})
    return spark.createDataFrame(table).selectExpr(*(f"cast({n} as {t}) as {n}" for n, t in (c.split() for c in schema.split(", "))))
