"""Vectors close to one another, as exact pairs found by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c), so the triangle
inequality holds. Equal vectors are one vector with a weight. The top of the tree is a set of pivots,
a bounded sample: each vector belongs to the nearest pivot of its label, and a cell's covering radius
is measured over all of its vectors. Pairs of cells whose pivots lie farther apart than both radii and
the threshold are pruned, and within a pair of cells each vector that lies too far from the other's
pivot. Cells too large for a task are cut into parts.

For each pair of parts a task builds a cover tree (nested levels, each of half the radius) and descends
both at once: node pairs too far apart are pruned by their covering radii, and node pairs that lie
wholly within the threshold are counted and linked without being spelled out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.components import connected
from orderlens.session import materialize

COSINE = 0.93
PART = 32_768
"""Vectors of one side of a task; each vector is sent to one task for every part it may have links in."""

PIVOTS = 1024
"""Rows sampled as pivots, at most; fewer where that many parts are not needed."""

SLACK = 1e-7
"""Bounds decide only beyond this distance from the threshold; nearer pairs are computed. A distance near zero is
wrong by some 2e-8, the root of what its cosine is wrong by."""

ROUGH = 1e-5
"""The same for cosines of single precision, which are wrong by less than a tenth of it."""

LEAF = 32

TOP = 1.0
"""Level of the root, whose children reach half as far. In many dimensions unrelated vectors lie farther apart,
and a node that holds two of them is so wide that it prunes nothing."""

BLOCK = 2048
"""Vectors whose cosines are held at once, with as many others."""

FINE = 1e-3
"""Radius below which a node is not opened: single precision does not tell its vectors apart."""


class Tree:
    """Cover tree of unit vectors: each node a centre, its members, and their largest distance from it. Children
    are given from the widest to the single vectors."""

    __slots__ = ("children", "members", "radius", "centre", "centres", "radii", "lone")

    def __init__(self, centre: int, members: np.ndarray, radius: float):
        self.centre, self.members, self.radius = centre, members, radius
        self.children: list[Tree] = []

    def adopt(self, children: list[Tree]) -> None:
        self.children = sorted(children, key=lambda child: -child.radius)
        self.centres = np.array([child.centre for child in self.children])
        self.radii = np.array([child.radius for child in self.children])
        self.lone = np.array([len(child.members) == 1 for child in self.children])

    def opened(self) -> Tree:
        """Itself, or, without children, a node of which it is the only child."""
        if self.children:
            return self
        node = Tree(self.centre, self.members, self.radius)
        node.adopt([self])
        return node


def _net(rough: np.ndarray, members: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres among ``members``, the first of them one, that lie farther than about ``reach`` apart, and of each
    member the place of a centre within about that distance. A block of members at a time meets the centres
    found before, and those that none of them reaches are looked at in order."""
    least = np.float32(1 - reach * reach / 2)
    centres = np.empty(len(members), np.int64)
    found, of = 0, np.empty(len(members), np.int64)
    for start in range(0, len(members), BLOCK):
        mine = members[start : start + BLOCK]
        nearest, cosine = np.zeros(len(mine), np.int64), np.full(len(mine), -2, np.float32)
        for at in range(0, found, BLOCK):
            cosines = rough[mine] @ rough[centres[at : min(found, at + BLOCK)]].T
            best = cosines.argmax(axis=1)
            value = np.take_along_axis(cosines, best[:, None], 1)[:, 0]
            nearest, cosine = np.where(value > cosine, at + best, nearest), np.maximum(value, cosine)
        claimed = cosine >= least
        of[start : start + BLOCK][claimed] = nearest[claimed]
        left = np.flatnonzero(~claimed)
        close = rough[mine[left]] @ rough[mine[left]].T >= least
        np.fill_diagonal(close, True)
        alone = close.sum(axis=1) == 1
        free = np.ones(len(left), bool)
        for i in range(len(left)):
            if not free[i]:
                continue
            centres[found] = mine[left[i]]
            if alone[i]:
                of[start + left[i]] = found
            else:
                taken = np.flatnonzero(close[i] & free)
                of[start + left[taken]] = found
                free[taken] = False
            found += 1
    return centres[:found], of


def build(vectors: np.ndarray) -> Tree:
    """Levels of radius 1, 1/2, 1/4 ...; a node's centre is the first of its children's centres too."""
    everything = np.arange(len(vectors))
    rough = vectors.astype(np.float32)
    root = Tree(0, everything, float(_distances(vectors, vectors[:1]).max()))
    open_ = [(root, TOP)]
    while open_:
        node, level = open_.pop()
        if len(node.members) <= LEAF or node.radius < FINE:
            continue
        while level / 2 >= node.radius:
            level /= 2
        reach = level / 2
        members = node.members
        first = np.flatnonzero(members == node.centre)[0]
        members[[0, first]] = members[[first, 0]]
        centres, of = _net(rough, members, reach)
        if len(centres) == 1:
            # So close to the reach that single precision cannot tell: a lower level parts them.
            open_.append((node, reach))
            continue
        order = np.argsort(of, kind="stable")
        sorted_members = members[order]
        apart = _apart(vectors, sorted_members, centres[of[order]])
        starts = np.flatnonzero(np.diff(of[order], prepend=-1))
        radii = np.maximum.reduceat(apart, starts)
        ends = np.append(starts[1:], len(members))
        children = []
        for centre, radius, start, end in zip(centres.tolist(), radii.tolist(), starts.tolist(), ends.tolist()):
            child = Tree(centre, sorted_members[start:end], radius if end - start > 1 else 0.0)
            children.append(child)
            if end - start > LEAF:
                open_.append((child, reach))
        node.adopt(children)
    return root


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _apart(vectors: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of vectors from others, one by one."""
    found = np.empty(len(a))
    for at in range(0, len(a), BLOCK):
        cosines = np.einsum("ij,ij->i", vectors[a[at : at + BLOCK]], vectors[b[at : at + BLOCK]])
        found[at : at + BLOCK] = np.sqrt(np.maximum(2 - 2 * cosines, 0))
    return found


class Links:
    """What a dual traversal finds: weighted numbers of links, and a spanning forest of them."""

    def __init__(self, size: int):
        self.counts = np.zeros(size, np.int64)
        self.parent = np.arange(size)

    def root(self, i: int) -> int:
        return int(self.roots(np.array([i]))[0])

    def roots(self, i: np.ndarray) -> np.ndarray:
        found = self.parent[i]
        while not np.array_equal(further := self.parent[found], found):
            found = further
        return found

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Put each of ``i`` and that of ``j`` under one root, the smallest. In each round every root that has a
        smaller neighbour goes under the smallest of them."""
        while True:
            i, j = self.roots(i), self.roots(j)
            apart = i != j
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            np.minimum.at(self.parent, np.maximum(i, j), np.minimum(i, j))

    def add(self, i: np.ndarray, j: np.ndarray, weights: np.ndarray) -> None:
        """A link between each of ``i`` and that of ``j``."""
        if len(i):
            np.add.at(self.counts, i, weights[j])
            np.add.at(self.counts, j, weights[i])
            self.join(i, j)
            self.parent[i], self.parent[j] = self.roots(i), self.roots(j)


def _kept(x: Tree, y: Tree, rough: tuple, limit: float, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of children that may hold a link, a block of pairs at a time. Within a block one cosine,
    that of its widest children, drops nearly all; the others are judged by their own radii."""
    for p in range(0, len(x.centres), BLOCK):
        mine, reach = rough[0][x.centres[p : p + BLOCK]], x.radii[p : p + BLOCK]
        for q in range(p if itself else 0, len(y.centres), BLOCK):
            cosines = mine @ rough[1][y.centres[q : q + BLOCK]].T
            others = y.radii[q : q + BLOCK]
            # Unit vectors are at most 2 apart.
            widest = min(reach[0] + others[0] + limit, 2)
            i, j = np.nonzero(cosines >= np.float32(1 - widest * widest / 2 - ROUGH))
            wide = np.minimum(reach[i] + others[j] + limit, 2)
            keep = cosines[i, j] >= 1 - wide * wide / 2 - ROUGH
            if itself and p == q:
                keep &= i <= j
            if keep.any():
                yield p + i[keep], q + j[keep]


def _close(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    """Whether each vector of ``left`` is close to that of ``right``, in double precision."""
    found = np.empty(len(i), bool)
    for at in range(0, len(i), BLOCK):
        some = slice(at, at + BLOCK)
        found[some] = np.einsum("ij,ij->i", left[i[some]], right[j[some]]) >= cosine
    return found


def traverse(
    a: Tree, b: Tree, left: np.ndarray, right: np.ndarray, shift: int, weights: np.ndarray, cosine: float
) -> Links:
    """Links between the vectors of two trees; ``right`` is numbered from ``shift`` on.

    ``shift`` 0 says that both are the same tree: each pair is met once and no vector links to itself.
    Single precision only drops pairs, with slack; what is left is computed in double precision.
    """
    links = Links(len(weights))
    same = shift == 0
    limit = float(np.sqrt(2 - 2 * cosine))
    rough = (left.astype(np.float32), right.astype(np.float32))
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        itself = same and x is y
        apart = 0.0 if itself else float(_distances(left[x.centre][None], right[y.centre][None])[0, 0])
        if apart > x.radius + y.radius + limit + SLACK:
            continue
        whole = (2 * x.radius if itself else apart + x.radius + y.radius) <= limit - SLACK
        if whole:
            i, j = x.members, y.members + shift
            links.counts[i] += weights[j].sum()
            if itself:
                links.counts[i] -= weights[i]
            else:
                links.counts[j] += weights[i].sum()
            others = np.concatenate([i[1:], j])
            links.join(np.full(len(others), i[0]), others)
            continue
        if not x.children and not y.children or len(x.members) * len(y.members) <= LEAF * LEAF:
            for p in range(0, len(x.members), BLOCK):
                for q in range(p if itself else 0, len(y.members), BLOCK):
                    mine, others = x.members[p : p + BLOCK], y.members[q : q + BLOCK]
                    close = left[mine] @ right[others].T >= cosine
                    at, bt = np.nonzero(np.triu(close, 1) if itself and p == q else close)
                    links.add(mine[at], others[bt] + shift, weights)
            continue
        x, y = x.opened(), y.opened()
        for i, j in _kept(x, y, rough, limit, itself):
            single = x.lone[i] & y.lone[j]
            p, q = x.centres[i[single]], y.centres[j[single]]
            if itself:
                p, q = p[i[single] != j[single]], q[i[single] != j[single]]
            close = _close(left, right, p, q, cosine)
            links.add(p[close], q[close] + shift, weights)
            stack += [(x.children[p], y.children[q]) for p, q in zip(i[~single].tolist(), j[~single].tolist())]
    return links


def _unit(frame: pd.DataFrame) -> np.ndarray:
    """Embeddings of one length divided by their norms, in double precision."""
    return np.array(frame["embedding"].tolist(), np.float64) / frame["norm"].to_numpy()[:, None]


def _pair(frame: pd.DataFrame) -> pd.DataFrame:
    """Links within one pair of parts: of each vector that has any its number of links and a partner."""
    sides = [frame[frame["side"] == s] for s in (0, 1)]
    sides = [s for s in sides if len(s)]
    empty = pd.DataFrame({"node": [], "partner": [], "n_links": []}).astype("int64")
    if len(sides) == 1 and not bool(frame["alone"].iloc[0]):
        return empty
    vectors = [_unit(s) for s in sides]
    trees = [build(v) for v in vectors]
    nodes = np.concatenate([s["node"].to_numpy() for s in sides])
    weights = np.concatenate([s["weight"].to_numpy() for s in sides])
    shift = len(vectors[0]) if len(sides) == 2 else 0
    links = traverse(trees[0], trees[-1], vectors[0], vectors[-1], shift, weights, COSINE)
    linked = np.flatnonzero(links.counts > 0)
    return pd.DataFrame({"node": nodes[linked], "partner": nodes[links.roots(linked)], "n_links": links.counts[linked]})


def _units(vectors: DataFrame) -> DataFrame:
    """Different valid vectors of each label with their norm, numbered and weighted by their rows. They are
    scaled to length one where they are used: what is stored and sent is the vector as it came."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x * x))
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & (norm > 0)
    # The norm is an aggregate, so it is not computed again for each component below.
    rows = vectors.where(valid).groupBy("label", "embedding").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("first"), F.first(norm).alias("norm")
    )
    rows = rows.select("label", "embedding", "weight", "first", "norm", F.size("embedding").alias("size"))
    return rows.withColumn("node", F.monotonically_increasing_id())


def _scaled() -> Column:
    return F.transform("embedding", lambda x: x.cast("double") / F.col("norm"))


def _celled(units: DataFrame) -> DataFrame:
    """``units`` with the nearest pivot of their label and vector length, its distance, and their part."""
    total = units.count()
    wanted = min(PIVOTS, -(-total // PART))
    sample = units.orderBy(F.xxhash64("node", F.lit("pivot"))).limit(wanted)
    sample = sample.select("label", "size", "node", _scaled().alias("unit"))
    pivots: dict[tuple, list] = {}
    for row in sample.collect():
        pivots.setdefault((row["label"], row["size"]), []).append((row["node"], row["unit"]))
    tables = {key: (np.array([n for n, _ in v]), np.array([u for _, u in v])) for key, v in pivots.items()}
    shared = units.sparkSession.sparkContext.broadcast(tables)

    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["cell"], frame["apart"] = -1, 2.0
            for key, rows in frame.groupby(["label", "size"]).groups.items():
                if key in shared.value:
                    names, centres = shared.value[key]
                    apart = _distances(_unit(frame.loc[rows]), centres)
                    frame.loc[rows, "cell"] = names[apart.argmin(axis=1)]
                    frame.loc[rows, "apart"] = apart.min(axis=1)
            yield frame

    label = units.schema["label"].dataType.simpleString()
    vector = units.schema["embedding"].dataType.simpleString()
    columns = f"label {label}, size int, node long, weight long, embedding {vector}, norm double, cell long, apart double"
    return units.select("label", "size", "node", "weight", "embedding", "norm").mapInPandas(nearest, columns)


def _meetings(units: DataFrame, cells: DataFrame) -> DataFrame:
    """Vectors of each pair of parts that may hold a link, with the side they are on."""
    limit = float(np.sqrt(2 - 2 * COSINE)) + SLACK
    key = ["label", "size", "cell"]
    counted = cells.groupBy(key).agg(F.count("*").alias("n"), F.max("apart").alias("radius"))
    pivots = units.select(F.col("node").alias("cell"), _scaled().alias("pivot"))
    counted = counted.withColumn("parts", F.ceil(F.col("n") / PART)).join(pivots, "cell", "left")
    counted = materialize(counted)
    a, b = (counted.select(*key[:2], *[F.col(c).alias(f"{c}_{s}") for c in ("cell", "radius", "parts", "pivot")]) for s in "ab")
    dot = F.aggregate(F.zip_with("pivot_a", "pivot_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.coalesce(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot)), F.lit(0.0))
    pairs = a.join(b, key[:2]).where("cell_a <= cell_b")
    pairs = pairs.where((F.col("cell_a") == F.col("cell_b")) | (apart <= F.col("radius_a") + F.col("radius_b") + limit))
    part = lambda s: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"parts_{s}") - 1)).alias(f"part_{s}")
    pairs = pairs.select("*", part("a")).select("*", part("b")).where("cell_a < cell_b or part_a <= part_b")
    alone = (F.col("cell_a") == F.col("cell_b")) & (F.col("part_a") == F.col("part_b"))
    pairs = pairs.select("label", "size", alone.alias("alone"), "cell_a", "part_a", "cell_b", "part_b",
                         "pivot_a", "pivot_b", "radius_a", "radius_b")
    # Stored, so that a pair keeps its number, which every vector of it carries.
    pairs = materialize(pairs.withColumn("pair", F.monotonically_increasing_id()))
    own = [F.lit(i).alias("side") for i in (0, 1)]
    sides = pairs.select(
        "label", "size", "pair", "alone", own[0], F.col("cell_a").alias("cell"), F.col("part_a").alias("part"),
        F.col("pivot_b").alias("other"), F.col("radius_b").alias("reach"),
    ).union(
        pairs.where("not alone").select(
            "label", "size", "pair", "alone", own[1], "cell_b", "part_b", "pivot_a", "radius_a",
        )
    )
    parted = cells.join(counted.select(*key, "parts"), key).withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    met = parted.join(sides, [*key, "part"])
    dot = F.aggregate(F.zip_with("embedding", "other", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    near = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot / F.col("norm"))) <= F.col("reach") + limit
    met = met.where(F.col("alone") | F.col("other").isNull() | near)
    return met.select("pair", "alone", "side", "node", "weight", "embedding", "norm")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id and kept.

    Rows link when their labels are equal and not null and the cosine of their embeddings, in double
    precision, is at least 0.93; embeddings of different lengths never do. An embedding that is null,
    empty, zero, or holds a null or a number that is not finite links with nothing, and its component
    is itself. Repeated vectors link with one another and count each. A null vec_id takes part but is
    never the smallest. Further columns are not read.
    """
    units = materialize(_units(vectors))
    cells = materialize(_celled(units))
    met = _meetings(units, cells)
    found = materialize(met.groupBy("pair").applyInPandas(_pair, "node long, partner long, n_links long"))
    roots = connected(found.select("node", "partner"), "node", "partner")
    counts = found.groupBy("node").agg(F.sum("n_links").alias("links"))
    nodes = units.select("label", "embedding", "weight", "first", "node").join(counts, "node", "left").join(roots, "node", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "node"))
    smallest = nodes.groupBy("root").agg(F.min("first").alias("smallest"))
    nodes = nodes.join(smallest, "root")
    links = (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    nodes = materialize(nodes.select("label", "embedding", links, "smallest"))
    component = F.coalesce("smallest", "vec_id")
    return vectors.select("vec_id", "label", "embedding").join(nodes, ["label", "embedding"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
