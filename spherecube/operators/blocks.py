"""Two-level spatial index of points in the plane: quadtree blocks for Spark's groups, a grid inside a block.

A block is a quadtree node with at most a given number of points; nodes with more are split. Only the split nodes are
kept (about a third of the number of blocks), and the level of a place is found by looking its nodes up level by level.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: levels beyond those that evenly spread points need; a block holds more points only where they crowd more than 4**8 fold
EXTRA_LEVELS = 8
_LEVEL = 56


class Blocks:
    """The quadtree over ``box`` (x_lo, x_hi, y_lo, y_hi) with the given split nodes (level -> sorted node numbers)."""

    def __init__(self, box: tuple[float, float, float, float], split: dict[int, np.ndarray]):
        self.box, self.split = box, split
        self.width, self.height = max(box[1] - box[0], 1e-12), max(box[3] - box[2], 1e-12)
        self.depth = max(split, default=-1) + 1

    def _places(self, x, y, level: int):
        side = 1 << level
        ix = np.clip(np.floor((x - self.box[0]) / self.width * side), 0, side - 1).astype(np.int64)
        iy = np.clip(np.floor((y - self.box[2]) / self.height * side), 0, side - 1).astype(np.int64)
        return ix, iy

    def _is_split(self, level: int, ix, iy) -> np.ndarray:
        nodes = self.split.get(level)
        if nodes is None or not len(nodes):
            return np.zeros(len(ix), dtype=bool)
        number = (iy << level) + ix
        return nodes[np.minimum(np.searchsorted(nodes, number), len(nodes) - 1)] == number

    def locate(self, x, y) -> np.ndarray:
        """Block of each place; places outside the box belong to the block at its edge."""
        block = np.zeros(len(x), dtype=np.int64)
        open_ = np.arange(len(x))
        for level in range(self.depth + 1):
            ix, iy = self._places(x[open_], y[open_], level)
            block[open_] = (level << _LEVEL) + (iy << level) + ix
            open_ = open_[self._is_split(level, ix, iy)]
        return block

    def around(self, x, y, halo: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, block) of every block that holds a place when widened by ``halo`` (at most a half) of its size."""
        rows, blocks = [], []
        for level in range(self.depth + 1):
            side = 1 << level
            dx, dy = halo * self.width / side, halo * self.height / side
            x_lo, y_lo = self._places(x - dx, y - dy, level)
            x_hi, y_hi = self._places(x + dx, y + dy, level)
            for ix, iy, extra in ((x_lo, y_lo, None), (x_hi, y_lo, x_hi > x_lo), (x_lo, y_hi, y_hi > y_lo), (x_hi, y_hi, (x_hi > x_lo) & (y_hi > y_lo))):
                row = np.arange(len(x)) if extra is None else np.flatnonzero(extra)
                ix, iy = ix[row], iy[row]
                leaf = ~self._is_split(level, ix, iy)
                if level:
                    leaf &= self._is_split(level - 1, ix >> 1, iy >> 1)
                rows.append(row[leaf])
                blocks.append((level << _LEVEL) + (iy[leaf] << level) + ix[leaf])
        return np.concatenate(rows), np.concatenate(blocks)

    def known(self, block: int, halo: float) -> tuple[float, float, float, float]:
        """The widened rectangle of a block; an edge beyond the box is infinitely far, since no point lies there."""
        level = block >> _LEVEL
        number = block & ((1 << _LEVEL) - 1)
        iy, ix = divmod(number, 1 << level)
        w, h = self.width / (1 << level), self.height / (1 << level)
        x_lo, x_hi = self.box[0] + (ix - halo) * w, self.box[0] + (ix + 1 + halo) * w
        y_lo, y_hi = self.box[2] + (iy - halo) * h, self.box[2] + (iy + 1 + halo) * h
        inf = math.inf
        return (-inf if x_lo <= self.box[0] else x_lo, inf if x_hi >= self.box[1] else x_hi, -inf if y_lo <= self.box[2] else y_lo, inf if y_hi >= self.box[3] else y_hi)


def split_nodes(points: DataFrame, box: tuple[float, float, float, float], n_points: int, limit: int) -> Blocks:
    """The quadtree of points (px, py) with at most ``limit`` in a block.

    Points are counted once per finest node, and those counts are added up for all levels. The driver gets the split
    nodes, of which there are about ``n_points / limit``.
    """
    deepest = max(0, math.ceil(math.log(max(n_points / limit, 1.0), 4))) + EXTRA_LEVELS
    side = 1 << deepest

    def place(column: str, lo: float, hi: float):
        at = F.floor((F.col(column) - lo) / max(hi - lo, 1e-12) * side)
        return F.greatest(F.lit(0).cast("bigint"), F.least(at, F.lit(side - 1).cast("bigint")))

    fine = points.groupBy(place("px", *box[:2]).alias("ix"), place("py", *box[2:]).alias("iy")).agg(F.count("*").alias("n"))
    each = fine.select("ix", "iy", "n", F.explode(F.sequence(F.lit(0), F.lit(deepest - 1))).alias("level"))
    node = F.expr(f"shiftleft(shiftright(iy, {deepest} - level), level) + shiftright(ix, {deepest} - level)")
    crowded = each.groupBy("level", node.alias("node")).agg(F.sum("n").alias("n")).filter(F.col("n") > limit).select("level", "node").toPandas()
    return Blocks(box, {int(level): np.sort(part.to_numpy()) for level, part in crowded.groupby("level")["node"]})


class PointGrid:
    """Points of one block in square cells, ``per_cell`` to a cell on average."""

    def __init__(self, ids, x, y, per_cell: int = 16):
        self.side = max(1, math.isqrt(len(x) // per_cell))
        self.x_lo, self.y_lo = x.min(), y.min()
        self.dx = max((x.max() - self.x_lo) / self.side, 1e-12)
        self.dy = max((y.max() - self.y_lo) / self.side, 1e-12)
        col, row = self._cells(x, y)
        order = np.argsort(row * self.side + col, kind="stable")
        self.ids, self.x, self.y = ids[order], x[order], y[order]
        self.starts = np.searchsorted((row * self.side + col)[order], np.arange(self.side * self.side + 1))

    def _cells(self, x, y):
        top = self.side - 1
        return (np.clip((x - self.x_lo) // self.dx, 0, top).astype(np.int64), np.clip((y - self.y_lo) // self.dy, 0, top).astype(np.int64))

    def nearest(self, x, y, ring: int, most: int, elements: int):
        """Up to ``most`` nearest points of each place within ``ring`` cells of its own: ids (-9 where there are
        fewer), coordinates (NaN there), and the radius within which no point of the block is left out."""
        n = len(x)
        ids, px, py = np.full((n, most), -9, dtype=np.int64), np.full((n, most), np.nan), np.full((n, most), np.nan)
        radius = np.full(n, np.inf)
        col, row = self._cells(x, y)
        order = np.argsort(row * self.side + col, kind="stable")
        cells, first = np.unique((row * self.side + col)[order], return_index=True)
        for cell, lo, hi in zip(cells.tolist(), first.tolist(), [*first[1:].tolist(), n], strict=True):
            r, c = divmod(cell, self.side)
            r_lo, r_hi, c_lo, c_hi = max(r - ring, 0), min(r + ring, self.side - 1), max(c - ring, 0), min(c + ring, self.side - 1)
            slices = [slice(self.starts[k * self.side + c_lo], self.starts[k * self.side + c_hi + 1]) for k in range(r_lo, r_hi + 1)]
            some = [np.concatenate([values[s] for s in slices]) for values in (self.ids, self.x, self.y)]
            size = len(some[0])
            step = max(1, elements // max(size, 1))
            for at in range(lo, hi, step):
                who = order[at : min(at + step, hi)]
                edge = np.full(len(who), np.inf)
                for open_, distance in ((r_lo > 0, y[who] - (self.y_lo + r_lo * self.dy)), (r_hi < self.side - 1, self.y_lo + (r_hi + 1) * self.dy - y[who]),
                                        (c_lo > 0, x[who] - (self.x_lo + c_lo * self.dx)), (c_hi < self.side - 1, self.x_lo + (c_hi + 1) * self.dx - x[who])):
                    if open_:
                        edge = np.minimum(edge, distance)
                if size > most:
                    d2 = (some[1] - x[who, None]) ** 2 + (some[2] - y[who, None]) ** 2
                    near = np.argpartition(d2, most - 1, axis=1)[:, :most]
                    ids[who], px[who], py[who] = (values[near] for values in some)
                    edge = np.minimum(edge, np.sqrt(np.take_along_axis(d2, near[:, most - 1 :], axis=1)[:, 0]))
                else:
                    ids[who, :size], px[who, :size], py[who, :size] = some
                radius[who] = edge
        return ids, px, py, radius


class BoxIndex:
    """Bounding boxes of blocks, gathered along the order of their numbers into about a square root of super-boxes.

    A test of many targets against all boxes runs against the super-boxes first, then inside those that were hit.
    """

    def __init__(self, boxes: np.ndarray):
        self.boxes = boxes
        size = max(1, math.isqrt(len(boxes)))
        self.starts = np.arange(0, len(boxes), size)
        self.ends = np.minimum(self.starts + size, len(boxes))
        lows = np.minimum.reduceat(boxes[:, [0, 2]], self.starts, axis=0)
        highs = np.maximum.reduceat(boxes[:, [1, 3]], self.starts, axis=0)
        self.supers = np.column_stack([lows[:, 0], highs[:, 0], lows[:, 1], highs[:, 1]])

    def hits(self, n: int, test) -> tuple[np.ndarray, np.ndarray]:
        """(target, box) pairs; ``test(targets, boxes)`` judges pairs of equal length."""
        target, box = _pairs(np.arange(n), np.zeros(n, dtype=np.int64), np.full(n, len(self.supers)))
        keep = test(target, self.supers[box])
        target, group = target[keep], box[keep]
        target, box = _pairs(target, self.starts[group], self.ends[group])
        keep = test(target, self.boxes[box])
        return target[keep], box[keep]


def _pairs(owner: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = ends - starts
    return np.repeat(owner, sizes), np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
