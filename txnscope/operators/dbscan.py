"""DBSCAN in tiles, on cells whose points are all neighbours.

1. **Points.** Equal feature vectors are one point with a weight, so a pile of copies
   costs one point; neighbour counts sum weights.
2. **Blocks.** A feature whose distinct values all lie more than ``eps`` apart (flags and
   coarse codes after scaling) must be equal for two points to be neighbours.
3. **Tiles.** Blocks larger than ``MAX_TILE`` points are cut along further features into
   tiles of side 2 eps, as many features as it takes; a point is also handed to the
   tiles within eps of it. A tile larger than ``SLICE`` is dealt in slices, and a task
   holds two slices: no task grows with the data.
4. **Leaves.** Inside a task the points are halved along their widest feature down to
   leaves of ``LEAF`` points. Two leaves are far apart, whole neighbours (by their boxes),
   or, only if neither is certain, their points are tested by one matrix product in single
   precision; pairs too close to eps for it are tested again exactly.
5. **Clusters.** Core points fall into cells of side eps / sqrt(d), so those of a cell are
   one cluster. A second pass over the tiles compares leaves of core points, leaving out
   the points already joined with the whole leaf, joins their cells inside the task, and
   hands out one link per cell to its local root. So what is written grows with the
   points, not with the pairs; components of those links are the clusters.
6. **Border points** take the smallest cluster among their core neighbours; the rest is
   noise (-1). Clusters are numbered 0.. in the order of their smallest core key.

Points with a missing feature have no neighbour and are noise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import checkpoint_dir
from .common import bounded_side
from .ranking import global_running_sum

PLAN_SAMPLE_ROWS = 1_000_000
#: Points of a tile above which it is cut further, and of a slice.
MAX_TILE = 400_000
SLICE = 100_000
#: Points of a leaf, and right points that are compared with a leaf at once.
LEAF = 128
WIDE = 2_048
#: Distances computed at once, and box gaps.
CHUNK = 2_000_000
PAIRS = 250_000
#: Cells of a group that are compared with the same other groups.
GROUP = 64


@dataclass
class TileSpec:
    features: list
    block: list
    grid: list
    eps: float

    @property
    def free(self) -> list:
        """The features in which neighbours may differ."""
        return [c for c in self.features if c not in self.block]

    @property
    def side(self) -> float:
        return 2.0 * self.eps

    def tiled(self, points: DataFrame, halo: bool) -> DataFrame:
        """``points`` with ``_tile`` and ``_own``; with ``halo`` also a row for each other
        tile within eps (a little more, so that rounding loses none)."""
        out = points.withColumn("_own", F.lit(True))
        reach, parts = self.eps * (1 + 1e-9), [F.col(c).cast("string") for c in self.block]
        for i, c in enumerate(self.grid):
            at = F.floor(F.col(c) / self.side)
            if halo:
                places = F.array(*[F.struct(F.lit(own).alias("own"), place.alias("at"))
                                   for own, place in (
                    (True, at), (False, F.when(F.floor((F.col(c) - reach) / self.side) < at, at - 1)),
                    (False, F.when(F.floor((F.col(c) + reach) / self.side) > at, at + 1)))])
                out = (out.withColumn("_p", F.explode(F.filter(places, lambda p: p["at"].isNotNull())))
                       .withColumns({"_own": F.col("_own") & F.col("_p.own"), f"_t{i}": F.col("_p.at")})
                       .drop("_p"))
            else:
                out = out.withColumn(f"_t{i}", at)
            parts.append(F.col(f"_t{i}").cast("string"))
        tile = F.concat_ws(",", *parts) if parts else F.lit("")
        return out.withColumn("_tile", tile).drop(*[f"_t{i}" for i in range(len(self.grid))])


def plan_tiles(df: DataFrame, features, eps: float, grid_dims: int | None = None,
               max_discrete: int = 64, max_tile: int | None = None) -> TileSpec:
    """Choose blocking features and the features that cut blocks into tiles.

    Blocking: one pass computes an approximate distinct count per feature (exact in its
    sparse range, far above ``max_discrete``); the values of the features with few of
    them are collected to find their smallest gap. Tiles: on a hash sample of at most
    ``PLAN_SAMPLE_ROWS`` points, features are added, each time the one that leaves the
    fewest pairs in common tiles, until the largest tile is small enough. The choice only
    affects speed, never the result.
    """
    feats, max_tile = list(features), max_tile or MAX_TILE
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.approx_count_distinct(c).alias(f"n_{i}") for i, c in enumerate(feats)]).first()
    low = [c for i, c in enumerate(feats) if (one[f"n_{i}"] or 0) <= max_discrete]
    block = []
    if low:
        vals = df.agg(*[F.array_sort(F.collect_set(c)).alias(f"v_{i}")
                        for i, c in enumerate(low)]).first()
        for i, c in enumerate(low):
            v = [x for x in (vals[f"v_{i}"] or []) if x is not None]
            gaps = [b - a for a, b in zip(v, v[1:])]
            if not gaps or min(gaps) > eps:
                block.append(c)
    spec = TileSpec(feats, block, [], eps)
    frac = min(1.0, PLAN_SAMPLE_ROWS / max(one["_n"], 1))
    sample = df if frac >= 1.0 else df.where(
        (F.xxhash64("_id").bitwiseAND(F.lit(0xFFFFFF)) / float(0x1000000)) < frac)

    def most(grid):
        tiles = TileSpec(feats, block, grid, eps).tiled(sample, False)
        return (tiles.groupBy("_tile").count().agg(F.max("count")).first()[0] or 0) / frac
    rest = spec.free
    while rest and len(spec.grid) < (len(spec.free) if grid_dims is None else grid_dims):
        if most(spec.grid) <= max_tile:
            break
        base = [F.col(c) for c in block] + [F.floor(F.col(c) / spec.side) for c in spec.grid]
        arr = F.array(*[F.struct(F.lit(i).alias("f"), F.floor(F.col(c) / spec.side).alias("cell"))
                        for i, c in enumerate(rest)])
        best = (sample.select(F.hash(*base).alias("_g") if base else F.lit(0).alias("_g"),
                              F.inline(arr))
                .groupBy("f", "_g", "cell").agg(F.count(F.lit(1)).alias("m"))
                .groupBy("f").agg(F.sum(F.col("m") * F.col("m")).alias("pairs"))
                .orderBy("pairs", "f").first())
        spec.grid.append(rest.pop(best["f"]))
    return spec


# --- inside a task: cells -----------------------------------------------------------------

def separating(x: np.ndarray, eps: float) -> np.ndarray:
    """Features in the order of the share of rows they leave within eps of a row."""
    left = []
    for v in np.sort(x, axis=0).T:
        left.append((np.searchsorted(v, v + eps) - np.searchsorted(v, v - eps)).sum())
    return np.argsort(left, kind="stable") if len(x) else np.arange(x.shape[1])


class Cells:
    """Points (rows of ``x``) grouped into cells of side eps / sqrt(d), with the box and the
    weight of each cell. Cells are ordered along the feature that separates them best;
    ``x`` and ``weight`` hold the points cell by cell from ``first`` on, and ``row`` their
    places in the given order."""

    def __init__(self, x: np.ndarray, eps: float, weight: np.ndarray):
        n, d = x.shape
        at = (np.floor(x * (math.sqrt(d) / eps)).astype(np.int64) if d
              else np.zeros((n, 1), np.int64))
        cell = np.unique(at, axis=0, return_inverse=True)[1].ravel() if n else np.zeros(0, np.int64)
        order = np.argsort(cell, kind="stable")
        first = np.flatnonzero(np.diff(cell[order], prepend=-1))
        lo = np.minimum.reduceat(x[order], first, axis=0) if n else x
        by = separating(lo, eps)
        place = np.empty(len(first), np.int64)
        place[np.argsort(lo[:, by[0]], kind="stable") if d else np.arange(len(first))] = np.arange(len(first))
        self._hold(x, weight, np.argsort(place[cell], kind="stable"), np.bincount(place[cell], minlength=len(first)))
        self.by = by

    def _hold(self, x, weight, row, size) -> None:
        self.row, self.size, self.first = row, size, np.cumsum(size) - size
        self.x, self.weight = x[row], weight[row]
        n = len(row)
        self.lo, self.hi = (f.reduceat(self.x, self.first, axis=0) if n else self.x
                            for f in (np.minimum, np.maximum))
        self.total = np.add.reduceat(self.weight, self.first) if n else np.zeros(0, np.int64)

    def __len__(self):
        return len(self.size)


class LonePoints(Cells):
    """Every point a cell of its own, in the given order."""

    def __init__(self, x: np.ndarray, weight: np.ndarray | None = None):
        ones = np.ones(len(x), np.int64)
        self._hold(x, ones if weight is None else weight, np.arange(len(x)), ones)
        self.by = np.arange(x.shape[1])


def _squares(parts: list[np.ndarray]) -> np.ndarray:
    """Sum of squares in the order of the features."""
    out = 0.0
    for p in parts:
        out = out + p * p
    return out


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, .. (size[0] of them), first[1], .."""
    stop = np.cumsum(size)
    return np.repeat(first - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)


class _Groups:
    """Cells next to each other along the features that separate them best: as many
    features as leave about ``GROUP`` cells to a group."""

    def __init__(self, cells: Cells, by: np.ndarray, eps: float):
        name = np.zeros(len(cells), np.int64)
        for self.n_by, k in enumerate(by, 1):
            at = np.floor(cells.lo[:, k] * (4.0 / eps))
            at = np.unique(at, return_inverse=True)[1].ravel()
            name = np.unique(name * (at.max() + 1) + at, return_inverse=True)[1].ravel()
            if len(name) <= GROUP * (name.max() + 1):
                break
        self.cells = np.argsort(name, kind="stable")
        self.size = np.bincount(name)
        self.first = np.cumsum(self.size) - self.size
        self.lo = np.minimum.reduceat(cells.lo[self.cells], self.first, axis=0)
        self.hi = np.maximum.reduceat(cells.hi[self.cells], self.first, axis=0)


def _balls(cells: Cells, centre: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """(a, last) of the ball around each box, eps / 2 wider: two balls touch where
    a . a' + last + last' >= 0."""
    mid = (cells.lo + cells.hi) / 2 - centre
    wide = (eps + np.linalg.norm(cells.hi - cells.lo, axis=1)) / 2
    return np.column_stack([mid, wide]), ((wide ** 2 - (mid ** 2).sum(axis=1)) / 2)[:, None]


def near_cells(left: Cells, right: Cells, eps: float):
    """(left cell, right cell, whole) of all pairs of cells whose boxes are within eps;
    ``whole``: so are all their points. Cells are compared group by group, with the groups
    whose boxes are within eps."""
    d = left.x.shape[1]
    if not len(left) or not len(right):
        return
    if not d:
        yield np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, bool)
        return
    limit = eps * eps

    def gap(i, j, c):
        return np.maximum(np.maximum(right.lo[j, c] - left.hi[i, c], left.lo[i, c] - right.hi[j, c]), 0.0)
    mine, theirs = _Groups(left, right.by, eps), _Groups(right, right.by, eps)
    centre = right.lo.mean(axis=0)
    (a, a_last), (b, b_last) = _balls(left, centre, eps), _balls(right, centre, eps)
    # one product tells which balls may touch; the slack is far above its rounding
    a, b = np.hstack([a, a_last, np.ones_like(a_last)]), np.hstack([b, np.ones_like(b_last), b_last])
    slack = -1e-9 * (limit + np.abs(a_last).max() + np.abs(b_last).max())
    for g in range(len(mine.size)):
        apart = np.maximum(np.maximum(theirs.lo - mine.hi[g], mine.lo[g] - theirs.hi), 0.0)
        near = np.flatnonzero((apart * apart).sum(axis=1) <= limit * (1 + 1e-9))
        if not len(near):
            continue
        others = theirs.cells[_runs(theirs.first[near], theirs.size[near])]
        cells = mine.cells[mine.first[g]:mine.first[g] + mine.size[g]]
        for lo in range(0, len(cells), 4 * GROUP):
            chosen = cells[lo:lo + 4 * GROUP]
            step = max(1, PAIRS // len(chosen))
            for start in range(0, len(others), step):
                j = others[start:start + step]
                at = np.flatnonzero(a[chosen] @ b[j].T >= slack)
                i, j = chosen[at // len(j)], j[at % len(j)]
                keep = _squares([gap(i, j, c) for c in range(d)]) <= limit
                i, j = i[keep], j[keep]
                far = [np.maximum(right.hi[j, c] - left.lo[i, c], left.hi[i, c] - right.lo[j, c])
                       for c in range(d)]
                if len(i):
                    yield i, j, _squares(far) <= limit


def point_pairs(left: Cells, right: Cells, i: np.ndarray, j: np.ndarray):
    """(pair, a, b, d2) of all points a, b of the pairs of cells (i, j): at most ``CHUNK``
    of them at once (or those of one left point). A pair may come in parts."""
    # a row for each left point of a pair, with all points of the right cell
    n = left.size[i]
    pair, a = np.repeat(np.arange(len(i)), n), _runs(left.first[i], n)
    size = right.size[j][pair]
    stop = np.cumsum(size)
    lo = 0
    while lo < len(pair):
        hi = max(lo + 1, int(np.searchsorted(stop, (stop[lo - 1] if lo else 0) + CHUNK, "right")))
        b = _runs(right.first[j[pair[lo:hi]]], size[lo:hi])
        p, of = np.repeat(pair[lo:hi], size[lo:hi]), np.repeat(a[lo:hi], size[lo:hi])
        yield p, of, b, _squares([left.x[of, c] - right.x[b, c] for c in range(left.x.shape[1])])
        lo = hi


class Leaves:
    """Points (rows of ``x``) halved along their widest feature down to leaves of at most
    ``most`` points (more only of equal ones), each with its box; ``x`` holds them leaf by
    leaf and ``row`` their places in the given order."""

    def __init__(self, x: np.ndarray, most: int):
        todo, leaves = [np.arange(len(x))] if len(x) else [], []
        while todo:
            rows = todo.pop()
            if len(rows) > most and x.shape[1]:
                inside = x[rows]
                wide = inside.max(axis=0) - inside.min(axis=0)
                k = int(wide.argmax())
                if wide[k] > 0:
                    order = np.argsort(inside[:, k], kind="stable")
                    v = inside[order, k]
                    # equal values stay together: the cut next to the middle
                    cuts = [c for c in (np.searchsorted(v, v[len(v) // 2], side)
                                        for side in ("left", "right")) if 0 < c < len(v)]
                    cut = min(cuts, key=lambda c: abs(c - len(v) // 2))
                    todo += [rows[order[cut:]], rows[order[:cut]]]
                    continue
            leaves.append(rows)
        self.size = np.array([len(r) for r in leaves], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.row = np.concatenate(leaves) if leaves else np.zeros(0, np.int64)
        self.x = x[self.row]
        self.lo, self.hi = (f.reduceat(self.x, self.first, axis=0) if leaves else self.x
                            for f in (np.minimum, np.maximum))


class Compared:
    """The points of two ``Leaves``, compared leaf by leaf with all points near it. Boxes
    are exact bounds, since rounding keeps the order of sums of squares."""

    def __init__(self, left: np.ndarray, right: np.ndarray, eps: float):
        self.mine, self.theirs, self.limit = Leaves(left, LEAF), Leaves(right, LEAF // 2), eps * eps
        x, y = self.mine.x, self.theirs.x
        self.columns = np.ascontiguousarray(y.T)
        centre = y.mean(axis=0) if len(y) else 0.0
        x, y = x - centre, y - centre
        x2, y2 = (x * x).sum(axis=1), (y * y).sum(axis=1)
        # a . b is (eps^2 - d^2) / 2
        self.a = np.column_stack([x, (self.limit - x2) / 2, np.ones(len(x))]).astype(np.float32)
        self.b = np.ascontiguousarray(np.column_stack([y, np.ones(len(y)), -y2 / 2]).T, np.float32)
        # far above the rounding of a product
        self.slack = np.float32((y.shape[1] + 8) * 2.0 ** -23 * (
            self.limit + x2.max(initial=0.0) + y2.max(initial=0.0)))

    def leaves(self):
        """For each left leaf its rows (a slice), the right points that are neighbours of all
        of them, and other right points near it, the nearest leaves first."""
        mine, theirs, d = self.mine, self.theirs, self.mine.x.shape[1]
        for i in range(len(mine.size) if len(theirs.size) else 0):
            lo, hi = mine.lo[i], mine.hi[i]
            gap = _squares([np.maximum(np.maximum(theirs.lo[:, c] - hi[c], lo[c] - theirs.hi[:, c]), 0.0)
                            for c in range(d)]) + np.zeros(len(theirs.size))
            far = _squares([np.maximum(theirs.hi[:, c] - lo[c], hi[c] - theirs.lo[:, c])
                            for c in range(d)]) + np.zeros(len(theirs.size))
            sure = far <= self.limit
            near = np.flatnonzero((gap <= self.limit) & ~sure)
            near = near[np.argsort(gap[near], kind="stable")]
            yield (slice(mine.first[i], mine.first[i] + mine.size[i]), lo, hi,
                   *(_runs(theirs.first[j], theirs.size[j]) for j in (np.flatnonzero(sure), near)))

    def within_box(self, columns: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Those of the right points that are within eps of a box."""
        y = self.columns[:, columns]
        y -= np.clip(y, lo[:, None], hi[:, None])
        return columns[np.einsum("ij,ij->j", y, y) <= self.limit * (1 + 1e-9)]

    def hits(self, rows: slice, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matrix of pairs that are neighbours, and the places in it that are not certain."""
        product = self.a[rows] @ self.b[:, columns]
        hit = product >= self.slack
        return hit, np.flatnonzero(hit ^ (product >= -self.slack))

    def neighbours(self, rows: slice, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of the slice, place in ``columns``) of the pairs that are neighbours."""
        hit, open_ = self.hits(rows, columns)
        sure = self.exact(rows.start + open_ // len(columns), columns[open_ % len(columns)])
        return np.divmod(np.concatenate([np.flatnonzero(hit), open_[sure]]), len(columns))

    def exact(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        x, y = self.mine.x, self.theirs.x
        return _squares([x[row, c] - y[column, c] for c in range(x.shape[1])]) <= self.limit


def neighbour_weights(left: Cells, right: Cells, eps: float) -> np.ndarray:
    """For each left point, the weight of the right points within eps."""
    pairs = Compared(left.x, right.x, eps)
    count, weight = np.zeros(len(left.x), np.int64), right.weight[pairs.theirs.row]
    # sums below 2^24 are exact in single precision
    factor = weight.astype(np.float32 if weight.sum() < 1 << 24 else np.float64)
    held, n = [], 0

    def settle():
        row, column = (np.concatenate(x) for x in zip(*held))
        hit = pairs.exact(row, column)
        np.add.at(count, row[hit], weight[column[hit]])
    for rows, lo, hi, sure, near in pairs.leaves():
        count[rows] += weight[sure].sum()
        for start in range(0, len(near), 8 * WIDE):
            close = pairs.within_box(near[start:start + 8 * WIDE], lo, hi)
            for at in range(0, len(close), WIDE):
                columns = close[at:at + WIDE]
                hit, open_ = pairs.hits(rows, columns)
                count[rows] += (hit.astype(factor.dtype) @ factor[columns]).astype(np.int64)
                if len(open_):
                    held.append((rows.start + open_ // len(columns), columns[open_ % len(columns)]))
                    n += len(open_)
                if n >= PAIRS:
                    settle()
                    held, n = [], 0
    if held:
        settle()
    out = np.empty(len(count), np.int64)
    out[left.row[pairs.mine.row]] = count
    return out


def joined_cells(left: np.ndarray, left_cell: np.ndarray, right: np.ndarray, right_cell: np.ndarray,
                 n: int, eps: float) -> np.ndarray:
    """Smallest cell joined with each of ``n`` cells, when cells with points within eps
    (of the left ones one of the right ones) are joined."""
    pairs, root = Compared(left, right, eps), np.arange(n)
    left_cell, right_cell = left_cell[pairs.mine.row], right_cell[pairs.theirs.row]

    def top(cells):
        found = root[cells]
        while (root[found] != found).any():
            found = root[found]
        return found

    def join(a, b):
        """Joins tops; only theirs change, the cells below them follow in ``top``."""
        some, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root[some] = some[joined_roots(np.arange(len(some)), at[:len(a)], at[len(a):])]
    for k, (rows, lo, hi, sure, near) in enumerate(pairs.leaves()):
        if k % GROUP == 0:
            root = top(np.arange(n))
        own = left_cell[rows]
        if len(sure):
            whole = np.unique(top(np.concatenate([own, right_cell[sure]])))
            if len(whole) > 1:
                join(whole[:-1], whole[1:])
        start, step = 0, WIDE // 4
        while start < len(near):
            columns, start, step = near[start:start + step], start + step, min(2 * step, 8 * WIDE)
            here = top(own)
            if (here == here[0]).all():        # what is joined with the whole leaf is not asked
                columns = columns[top(right_cell[columns]) != here[0]]
            columns = pairs.within_box(columns, lo, hi)
            for at in range(0, len(columns), WIDE):
                some = columns[at:at + WIDE]
                here, there = top(own), top(right_cell[some])
                i, j = pairs.neighbours(rows, some)
                new = here[i] != there[j]
                if new.any():
                    kinds = np.unique(here[i[new]] * n + there[j[new]])
                    join(kinds // n, kinds % n)
    return top(np.arange(n))


def touching_cells(left: Cells, right: Cells, eps: float):
    """(left cells, right cells) with a point each within eps, a few pairs at a time; a pair
    may come again."""
    pairs = Compared(left.x, right.x, eps)
    mine, theirs = (np.repeat(np.arange(len(c)), c.size)[side.row]
                    for c, side in ((left, pairs.mine), (right, pairs.theirs)))
    for rows, lo, hi, sure, near in pairs.leaves():
        if len(sure):
            i, j = np.unique(mine[rows]), np.unique(theirs[sure])
            yield np.repeat(i, len(j)), np.tile(j, len(i))
        for start in range(0, len(near), 8 * WIDE):
            close = pairs.within_box(near[start:start + 8 * WIDE], lo, hi)
            for at in range(0, len(close), WIDE):
                i, j = pairs.neighbours(rows, close[at:at + WIDE])
                kinds = np.unique(mine[rows][i] * len(right) + theirs[close[at:at + WIDE]][j])
                yield kinds // len(right), kinds % len(right)


def joined_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node connected to each node when the pairs (a, b) join the components
    ``root`` (their smallest nodes), by minimum labels and pointer jumping."""
    a, b = root[a], root[b]
    open_ = a != b
    a, b = a[open_], b[open_]
    label = root.copy()
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


# --- tiles as groups ----------------------------------------------------------------------

def _dealt(left: DataFrame, right: DataFrame | None, spec: TileSpec) -> DataFrame:
    """Rows per task: the number of its tile ``_t`` and two slices ``_i`` and ``_j`` (each
    is compared with the other), the row's slice ``_a``, and which sides of the comparison
    it is on. Without ``right`` the points are compared with themselves."""
    if right is None:
        rows = spec.tiled(left, True).withColumns({"_left": F.col("_own"), "_right": F.lit(True)})
    else:
        rows = (spec.tiled(left, False).withColumns({"_left": F.lit(True), "_right": F.lit(False)})
                .unionByName(spec.tiled(right, True).withColumns(
                    {"_left": F.lit(False), "_right": F.lit(True)}), allowMissingColumns=True))
    # tiles without a row on either side compare nothing; the others get a number
    sizes = (rows.groupBy("_tile").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("_s"),
                                       (F.max("_left") & F.max("_right")).alias("_both"))
             .where("_both").drop("_both").withColumn("_t", F.monotonically_increasing_id()))
    sizes = bounded_side(sizes.checkpoint(eager=True))
    mine = F.pmod(F.xxhash64("_id"), F.col("_s").cast("bigint")).cast("int")
    k = F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("_k")
    return (rows.join(sizes, "_tile").withColumn("_a", mine).select("*", k)
            .withColumns({"_i": F.least("_a", "_k"), "_j": F.greatest("_a", "_k")})
            .drop("_tile", "_own", "_s", "_k", *spec.block))


def _compared(left: DataFrame, right: DataFrame | None, spec: TileSpec, fn, schema: str) -> DataFrame:
    """``fn(left rows, right rows)`` of every task."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        left, right, a = g[g["_left"]], g[g["_right"]], int(g["_i"].iloc[0])
        if a == g["_j"].iloc[0]:
            return fn(left, right)
        return pd.concat([fn(left[(left["_a"] == a) == one], right[(right["_a"] == a) != one])
                          for one in (True, False)])
    # few bytes but much work: several tasks per core, however small they are
    spark = left.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
            4 * spark.sparkContext.defaultParallelism)
    return (_dealt(left, right, spec).repartition(n, "_t", "_i", "_j")
            .groupBy("_t", "_i", "_j").applyInPandas(run, schema))


def _cells(rows: pd.DataFrame, spec: TileSpec) -> Cells:
    weight = rows["_w"].to_numpy(np.int64) if "_w" in rows else np.ones(len(rows), np.int64)
    return Cells(rows[spec.free].to_numpy(np.float64), spec.eps, weight)


def neighbour_counts(points: DataFrame, spec: TileSpec) -> DataFrame:
    """(_id, _nb): rows within eps of each point, itself included."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        n = neighbour_weights(*(LonePoints(x[spec.free].to_numpy(np.float64), x["_w"].to_numpy(np.int64))
                                for x in (left, right)), spec.eps)
        return pd.DataFrame({"_id": left["_id"].array, "_nb": n})
    return (_compared(points, None, spec, run, "_id string, _nb long")
            .groupBy("_id").agg(F.sum("_nb").alias("_nb")))


def cell_links(points: DataFrame, spec: TileSpec) -> DataFrame:
    """(border, a, b) of points with ``_cell`` (the name of their core cell; null: not a
    core point): core cells with the root of their local component, and non-core points
    (border) with the local components next to them."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right[right["_cell"].notna()]
        solid = left["_cell"].notna()
        inner, outer = left[solid], left[~solid]
        code, names = pd.factorize(np.concatenate([right["_cell"], inner["_cell"]]), sort=True)
        x, inside, outside = (r[spec.free].to_numpy(np.float64) for r in (right, inner, outer))
        root = joined_cells(inside, code[len(right):], x, code[:len(right)], len(names), spec.eps)
        linked = np.flatnonzero(root != np.arange(len(names)))
        near, of = [np.zeros((2, 0), np.int64)], root[code[:len(right)]]
        for point, j in touching_cells(LonePoints(outside), LonePoints(x), spec.eps):
            near.append(np.unique(np.stack([point, of[j]]), axis=1))
        near = np.unique(np.concatenate(near, axis=1), axis=1)
        ids = outer["_id"].to_numpy()
        return pd.DataFrame({
            "border": np.repeat([False, True], [len(linked), near.shape[1]]),
            "a": np.concatenate([names[linked].astype(object), ids[near[0]]]),
            "b": np.concatenate([names[root[linked]], names[near[1]]]).astype(object)})
    return _compared(points, None, spec, run, "border boolean, a string, b string").distinct()


def connected_components(edges: DataFrame, nodes: DataFrame, checkpoint_every: int = 3) -> DataFrame:
    """(node, label) with label = smallest node id of its component.

    ``edges`` (src, dst) must be symmetric and should be materialised. Each
    round takes the minimum label over neighbours, then jumps pointers
    (label := label of label), which shortens long chains geometrically. The
    round's result is cached (checkpointed every few rounds) by the same job
    that counts the changed labels.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    labels = nodes.select(F.col("node"), F.col("node").alias("label")).checkpoint(eager=True)
    previous = None
    i = 0
    while True:
        i += 1
        nb = (edges.join(labels.withColumnRenamed("node", "dst"), "dst")
              .groupBy(F.col("src").alias("node")).agg(F.min("label").alias("_nl")))
        step = (labels.join(nb, "node", "left")
                .select("node", F.col("label").alias("_old"),
                        F.least("label", F.coalesce("_nl", "label")).alias("label")))
        jump = (step.join(step.select(F.col("node").alias("label"), F.col("label").alias("_ll")),
                          "label", "left")
                .select("node", "_old", F.least("label", F.coalesce("_ll", "label")).alias("label")))
        jump = jump.checkpoint(eager=True) if i % checkpoint_every == 0 else jump.cache()
        changed = jump.agg(F.count_if(F.col("label") != F.col("_old")).alias("c")).first()["c"]
        if previous is not None:
            previous.unpersist()
        previous = jump
        labels = jump.drop("_old")
        if changed == 0:
            return labels


# --- model ----------------------------------------------------------------------------------

def _complete(columns) -> F.Column:
    """No feature is missing or not a number."""
    return reduce(and_, [F.col(c).isNotNull() & ~F.isnan(c) for c in columns])


@dataclass
class DbscanModel:
    spec: TileSpec
    labels: DataFrame        # (_id, cluster, is_core, n_neighbours) per training row
    core_points: DataFrame   # (_id, features..., cluster) of core points

    def assign(self, df: DataFrame, key: str = "transaction_id") -> DataFrame:
        """Cluster of the nearest training core point within eps (else -1)."""
        spec = self.spec
        feats = [F.col(c).cast("double").alias(c) for c in spec.features]
        # equal feature vectors are placed once
        pts = (df.groupBy(*feats).agg(F.min(F.col(key).cast("string")).alias("_id"))
               .where(_complete(spec.features)))

        # a copy of a core point is nearest to that one
        cores = self.core_points
        known = cores.select(*spec.features, F.col("cluster").alias("_at"))
        pts = pts.join(known, spec.features, "left").checkpoint(eager=True)

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            right = right.sort_values("_id")
            x, cells = LonePoints(left[spec.free].to_numpy(np.float64)), _cells(right, spec)
            row, low = np.zeros(len(left), np.int64), np.full(len(left), np.inf)
            for i, j, _ in near_cells(x, cells, spec.eps):
                for _, a, b, d2 in point_pairs(x, cells, i, j):
                    b, best = cells.row[b], np.full(len(low), np.inf)
                    np.minimum.at(best, a, d2)
                    nearest = np.full(len(low), len(right))
                    tied = d2 == best[a]
                    np.minimum.at(nearest, a[tied], b[tied])       # of equals the smallest id
                    better = (best < low) | ((best == low) & (nearest < row) & (best < np.inf))
                    low[better], row[better] = best[better], nearest[better]
            hit = low <= spec.eps * spec.eps
            return pd.DataFrame({"_id": left["_id"].to_numpy()[hit], "d2": low[hit],
                                 "core": right["_id"].to_numpy()[row[hit]],
                                 "cluster": right["cluster"].to_numpy()[row[hit]].astype("int32")})
        found = _compared(pts.where("_at IS NULL").drop("_at"), cores, spec, run,
                          "_id string, d2 double, core string, cluster int")
        best = found.groupBy("_id").agg(F.min_by("cluster", F.struct("d2", "core")).alias("cluster"))
        best = best.unionByName(pts.where("_at IS NOT NULL").select("_id", F.col("_at").alias("cluster")))
        placed = pts.join(best, "_id").select(
            "cluster", *[F.col(c).alias(f"_v_{c}") for c in spec.features])
        same = [F.col(c).cast("double").eqNullSafe(F.col(f"_v_{c}")) for c in spec.features]
        return (df.join(placed, reduce(and_, same), "left")
                .drop(*[f"_v_{c}" for c in spec.features]).fillna({"cluster": -1}))


def fit_dbscan(df: DataFrame, feature_cols, key: str = "transaction_id",
               eps: float = fixed.DBSCAN_EPS, min_samples: int = fixed.DBSCAN_MIN_SAMPLES,
               grid_dims: int | None = None, max_tile: int | None = None) -> DbscanModel:
    """DBSCAN over the rows of ``df`` (see module docstring): exactly that of the rows."""
    feats = list(feature_cols)
    checkpoint_dir(df.sparkSession)
    rows = df.select(F.col(key).cast("string").alias("_id"),
                     *[F.col(c).cast("double").alias(c) for c in feats])
    pts = (rows.where(_complete(feats)).groupBy(*feats)
           .agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_w")).checkpoint(eager=True))
    spec = plan_tiles(pts, feats, eps, grid_dims, max_tile=max_tile)
    counted = pts.join(neighbour_counts(pts, spec), "_id").checkpoint(eager=True)
    # a core cell is named by its smallest core point
    is_core = F.col("_nb") >= min_samples
    at = [F.col(c) for c in spec.block] + [F.floor(F.col(c) * (math.sqrt(len(spec.free)) / eps))
                                           for c in spec.free]
    core = counted.where(is_core).withColumn("_at", F.struct(*at))
    names = core.groupBy("_at").agg(F.min("_id").alias("_cell"))
    core = core.join(names, "_at").select("_id", "_cell").checkpoint(eager=True)
    links = cell_links(counted.join(core, "_id", "left"), spec).checkpoint(eager=True)
    edges = links.where("NOT border").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    edges = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    comp = connected_components(edges, core.select(F.col("_cell").alias("node")).distinct())
    numbered = global_running_sum(comp.select("label").distinct(), [F.col("label")],
                                  F.lit(1).cast("bigint"), "_cno")
    clusters = comp.join(numbered, "label").select(
        F.col("node").alias("_cell"), (F.col("_cno") - 1).cast("int").alias("cluster"))
    clusters = clusters.checkpoint(eager=True)
    core_cl = core.join(clusters, "_cell").select("_id", "cluster")
    border = (links.where("border").join(clusters, F.col("b") == F.col("_cell"))
              .groupBy(F.col("a").alias("_id")).agg(F.min("cluster").alias("cluster")))
    assigned = core_cl.withColumn("is_core", F.lit(True)).unionByName(
        border.withColumn("is_core", F.lit(False)))
    vec_labels = counted.join(assigned, "_id", "left").select(*feats, "cluster", "is_core", "_nb")
    labels = (rows.join(vec_labels, feats, "left")
              .select("_id", F.coalesce("cluster", F.lit(-1)).alias("cluster"),
                      F.coalesce("is_core", F.lit(False)).alias("is_core"),
                      F.coalesce("_nb", F.lit(0)).cast("bigint").alias("n_neighbours"))
              .checkpoint(eager=True))
    core_points = pts.drop("_w").join(core_cl, "_id").checkpoint(eager=True)
    return DbscanModel(spec, labels, core_points)


def cluster_fraud_rates(labels: DataFrame, df: DataFrame, key: str = "transaction_id",
                        label: str = "fraud_flag") -> DataFrame:
    """Mean label per cluster, noise excluded."""
    return (labels.where(F.col("cluster") != -1)
            .join(df.select(F.col(key).cast("string").alias("_id"), label), "_id")
            .groupBy("cluster").agg(F.avg(F.col(label).cast("double")).alias("fraud_rate"),
                                    F.count(F.lit(1)).alias("size")))


def anomaly_clusters(rates: DataFrame, threshold: float = fixed.FRAUD_THRESHOLD) -> DataFrame:
    return rates.where(F.col("fraud_rate") > threshold)
