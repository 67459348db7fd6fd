"""Delaunay weights for curvilinear and unstructured grids, without a global triangulation.

Lifting each source point to height x^2 + y^2 turns the Delaunay triangle around a target into the
lowest triangle of lifted points above it: a linear programme with three unknown vertices. A
target therefore only needs its current best triangle; any source point below the plane of that
triangle (inside its circumcircle) improves it, and when there is none anywhere the triangle is the
Delaunay one.

Spark does the spatial work. Points fall into quadtree blocks of similar size (see :mod:`blocks`); a block also gets the
points of a halo around it. In one grouped pass every target looks at its nearest points, then at more of them, then at
all points of its block. A target is settled when its circumcircle holds no place whose points it hasn't seen. Only
targets whose circle leaves the halo go round again: they visit the blocks their circle touches, until none improves them.
Groups are pairs of a block and a run of cells, so neither many points nor many targets in one area meet in one task.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.operators.blocks import Blocks, BoxIndex, PointGrid, split_nodes
from spherecube.operators.grids import shifted_copies
from spherecube.operators.weights import longitude_frame, one_per_location
from spherecube.session import cut_lineage

log = logging.getLogger(__name__)

IDS, XS, YS = ["i0", "i1", "i2"], ["x0", "x1", "x2"], ["y0", "y1", "y2"]
STATE = ["cell", "x", "y", *IDS, *XS, *YS]
NEW_IDS, NEW_XS, NEW_YS = ["j0", "j1", "j2"], ["u0", "u1", "u2"], ["v0", "v1", "v2"]
STATE_SCHEMA = "cell bigint, x double, y double, " + ", ".join(
    [f"{c} bigint" for c in IDS] + [f"{c} double" for c in XS + YS]
)
VISIT_SCHEMA = STATE_SCHEMA + ", leaf bigint"
SEARCH_SCHEMA = STATE_SCHEMA + ", changed boolean, " + ", ".join(
    [f"{c} bigint" for c in NEW_IDS] + [f"{c} double" for c in NEW_XS + NEW_YS]
)
N_DIRECTIONS = 8
TARGETS_PER_GROUP = 20_000
MATRIX_ELEMENTS = 4_000_000
#: part of its size that a block sees around itself
HALO = 0.25
#: (cells to either side, nearest points) a target looks at before all points of its block
NEAR = ((1, 24), (4, 128))
#: cells of one group at most, a run of consecutive numbers
CELLS_PER_GROUP = 65_536
#: blocks the driver keeps track of; larger grids get larger blocks
MAX_BLOCKS = 100_000
FRAME_POINTS = 2_048


# --- the small solver used inside tasks ---------------------------------------------------------


def _plane(qx, qy, ids, vx, vy):
    """Barycentric weights of each target and the plane through its three lifted vertices.

    While a placeholder vertex (negative id) carries weight the height is 1 for placeholders and 0
    for real points, so lowering it drives placeholders out; after that it is the lifted height.
    All coordinates are relative to the target.
    """
    dx, dy = vx - qx[:, None], vy - qy[:, None]
    area = (dx[:, 1] - dx[:, 0]) * (dy[:, 2] - dy[:, 0]) - (dx[:, 2] - dx[:, 0]) * (dy[:, 1] - dy[:, 0])
    nxt, prv = [1, 2, 0], [2, 0, 1]
    w = np.maximum((dx[:, nxt] * dy[:, prv] - dx[:, prv] * dy[:, nxt]) / area[:, None], 0.0)
    placeholder = ids < 0
    outside = (w * placeholder).sum(axis=1) > 1e-11
    h = np.where(outside[:, None], placeholder.astype(float), dx * dx + dy * dy)
    h1, h2 = h[:, 1] - h[:, 0], h[:, 2] - h[:, 0]
    b = (h1 * (dy[:, 2] - dy[:, 0]) - h2 * (dy[:, 1] - dy[:, 0])) / area
    c = ((dx[:, 1] - dx[:, 0]) * h2 - (dx[:, 2] - dx[:, 0]) * h1) / area
    a = h[:, 0] - b * dx[:, 0] - c * dy[:, 0]
    real_height = np.where(placeholder, 0.0, h).max(axis=1)
    tol = np.where(outside, 1e-11, 1e-10 * real_height + 1e-18)
    return dx, dy, area, w, outside, a, b, c, tol


def improve(qx, qy, ids, vx, vy, cid, cx, cy):
    """Lowest triangles over candidates; ``cx`` is (points,) for all targets or (targets, points).

    Returns new (ids, vx, vy). Simplex steps with the most violated point; after many steps the
    lowest-index rule, which cannot cycle.
    """
    ids, vx, vy = ids.copy(), vx.copy(), vy.copy()
    per_target = cx.ndim == 2
    active = np.arange(len(qx)) if cx.shape[-1] else np.arange(0)
    steps = 0
    while len(active):
        steps += 1
        if steps > 5000:
            raise RuntimeError("triangle search does not settle")
        dx, dy, area, w, outside, a, b, c, tol = _plane(
            qx[active], qy[active], ids[active], vx[active], vy[active]
        )
        rx = (cx[active] if per_target else cx[None, :]) - qx[active][:, None]
        ry = (cy[active] if per_target else cy[None, :]) - qy[active][:, None]
        gap = np.where(outside[:, None], 0.0, rx * rx + ry * ry) - (a[:, None] + b[:, None] * rx + c[:, None] * ry)
        gap = np.where(np.isnan(gap), np.inf, gap)
        j = gap.argmin(axis=1) if steps <= 100 else (gap < -tol[:, None]).argmax(axis=1)
        row = np.arange(len(active))
        go = gap[row, j] < -tol
        if not go.any():
            break
        row, j = row[go], j[go]
        px, py = rx[row, j], ry[row, j]
        ex, ey = dx[go] - px[:, None], dy[go] - py[:, None]
        nxt, prv = [1, 2, 0], [2, 0, 1]
        share = (ex[:, nxt] * ey[:, prv] - ex[:, prv] * ey[:, nxt]) / area[go][:, None]
        ratio = np.where(share > 1e-12, w[go] / np.where(share > 1e-12, share, 1.0), np.inf)
        tied = ratio <= ratio.min(axis=1)[:, None]
        leave = np.where(tied, ids[active[go]], np.iinfo(np.int64).max).argmin(axis=1)
        moved = active[go]
        ids[moved, leave] = cid[moved, j] if per_target else cid[j]
        vx[moved, leave] = cx[moved, j] if per_target else cx[j]
        vy[moved, leave] = cy[moved, j] if per_target else cy[j]
        active = moved
    return ids, vx, vy


def _improve_blocks(pdf, cid, cx, cy):
    """Run :func:`improve` over slices of targets so the distance matrix stays small."""
    block = max(1, MATRIX_ELEMENTS // max(1, len(cx)))
    out = []
    for lo in range(0, len(pdf), block):
        part = pdf.iloc[lo : lo + block]
        out.append(
            improve(part["x"].to_numpy(), part["y"].to_numpy(), part[IDS].to_numpy(), part[XS].to_numpy(),
                    part[YS].to_numpy(), cid, cx, cy)
        )
    return [np.concatenate(arrays) for arrays in zip(*out)]


def _with_basis(pdf, ids, vx, vy):
    fresh = pdf[["cell", "x", "y"]].copy()
    for k in range(3):
        fresh[IDS[k]], fresh[XS[k]], fresh[YS[k]] = ids[:, k], vx[:, k], vy[:, k]
    return fresh[STATE]


# --- Spark stages -------------------------------------------------------------------------------


def _leaf_facts(leaf_points: DataFrame) -> tuple[np.ndarray, list[float], list, dict]:
    """Per leaf its bounding box; over all points the farthest in a fixed set of directions; some points as a frame."""
    angles = [2 * math.pi * i / N_DIRECTIONS for i in range(N_DIRECTIONS)]
    reach = [
        F.max(F.struct((F.col("px") * math.cos(t) + F.col("py") * math.sin(t)).alias("d"), "pid", "px", "py")).alias(f"e{i}")
        for i, t in enumerate(angles)
    ]
    leaves = leaf_points.groupBy("leaf").agg(
        F.min("px").alias("x_lo"), F.max("px").alias("x_hi"), F.min("py").alias("y_lo"), F.max("py").alias("y_hi"),
        F.min(F.struct("pid", "px", "py")).alias("rep"), *reach,
    ).collect()
    boxes = np.array([[r.leaf, r.x_lo, r.x_hi, r.y_lo, r.y_hi] for r in leaves], dtype=object)
    extremes = [max((r[f"e{i}"] for r in leaves), key=lambda e: (e.d, e.pid)) for i in range(N_DIRECTIONS)]
    some = sorted(leaves, key=lambda r: r.leaf)[:: -(-len(leaves) // FRAME_POINTS)]
    return boxes, angles, extremes, {r.pid: (r.px, r.py) for r in [*extremes, *[leaf.rep for leaf in some]]}


def _reach(state: tuple) -> np.ndarray:
    """How far from its target a circumcircle reaches at most; endless while no circle encloses the target."""
    _, _, _, _, outside, a, b, c, _ = state
    with np.errstate(invalid="ignore"):
        reach = np.hypot(b / 2, c / 2) + np.sqrt(np.maximum(a + (b * b + c * c) / 4, 0.0))
    return np.where(outside | ~np.isfinite(reach), np.inf, reach * (1 + 1e-9))


def _search_block(blocks: Blocks, corner_x: np.ndarray, corner_y: np.ndarray) -> Callable:
    """cogroup function: the targets of a group with the best triangle that the points around them allow, and whether
    no other point can improve it."""

    def search(key: tuple, targets: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        n = len(targets)
        qx, qy = targets["x"].to_numpy(dtype=float), targets["y"].to_numpy(dtype=float)
        ids, vx, vy = np.tile(np.array([-1, -2, -3]), (n, 1)), np.tile(corner_x, (n, 1)), np.tile(corner_y, (n, 1))
        x_lo, x_hi, y_lo, y_hi = blocks.known(int(key[0]), HALO)
        seen = np.minimum(np.minimum(qx - x_lo, x_hi - qx), np.minimum(qy - y_lo, y_hi - qy))
        settled = np.zeros(n, dtype=bool)
        if n and len(points):
            pid, px, py = points["pid"].to_numpy(), points["px"].to_numpy(), points["py"].to_numpy()
            grid = PointGrid(pid, px, py)
            for ring, most in NEAR:
                if most >= len(pid):
                    break
                todo = np.flatnonzero(~settled)
                for lo in range(0, len(todo), MATRIX_ELEMENTS // most):
                    t = todo[lo : lo + MATRIX_ELEMENTS // most]
                    cid, cx, cy, radius = grid.nearest(qx[t], qy[t], ring, most, MATRIX_ELEMENTS)
                    ids[t], vx[t], vy[t] = improve(qx[t], qy[t], ids[t], vx[t], vy[t], cid, cx, cy)
                    settled[t] = _reach(_plane(qx[t], qy[t], ids[t], vx[t], vy[t])) <= np.minimum(radius, seen[t])
            todo = np.flatnonzero(~settled)
            step = max(1, MATRIX_ELEMENTS // len(pid))
            for lo in range(0, len(todo), step):
                t = todo[lo : lo + step]
                ids[t], vx[t], vy[t] = improve(qx[t], qy[t], ids[t], vx[t], vy[t], pid, px, py)
                settled[t] = _reach(_plane(qx[t], qy[t], ids[t], vx[t], vy[t])) <= seen[t]
        out = _with_basis(targets, ids, vx, vy)
        out["settled"] = settled
        return out

    return search


def _touched_leaves(boxes: np.ndarray) -> Callable:
    """mapInPandas function: one row per target and leaf that may hold a better vertex.

    ``boxes`` has one (leaf, x_lo, x_hi, y_lo, y_hi) row per leaf. A target that touches no leaf
    comes out once with a NULL leaf.
    """
    order = np.argsort(boxes[:, 0])
    leaf, index = boxes[order, 0].astype("int64"), BoxIndex(boxes[order, 1:].astype(float))

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = max(1, MATRIX_ELEMENTS // (4 * len(index.supers)))
        for pdf in batches:
            for lo in range(0, len(pdf), block):
                part = pdf.iloc[lo : lo + block]
                qx, qy = part["x"].to_numpy(), part["y"].to_numpy()
                _, _, _, _, outside, a, b, c, tol = _plane(
                    qx, qy, part[IDS].to_numpy(), part[XS].to_numpy(), part[YS].to_numpy()
                )

                def may_improve(t: np.ndarray, box: np.ndarray) -> np.ndarray:
                    x_lo, x_hi, y_lo, y_hi = (box[:, k] - q[t] for k, q in enumerate((qx, qx, qy, qy)))
                    beyond = a[t] + np.maximum(b[t] * x_lo, b[t] * x_hi) + np.maximum(c[t] * y_lo, c[t] * y_hi) > tol[t]
                    near_x, near_y = np.clip(b[t] / 2, x_lo, x_hi), np.clip(c[t] / 2, y_lo, y_hi)
                    in_circle = near_x**2 + near_y**2 - (a[t] + b[t] * near_x + c[t] * near_y) < -tol[t]
                    return np.where(outside[t], beyond, in_circle)

                t, l = index.hits(len(part), may_improve)
                none = np.setdiff1d(np.arange(len(part)), t)
                rows = part[STATE].iloc[np.concatenate([t, none])].copy()
                rows["leaf"] = pd.array(
                    np.concatenate([leaf[l], np.full(len(none), -1)]), dtype="Int64"
                )
                rows.loc[rows["leaf"] == -1, "leaf"] = pd.NA
                yield rows

    return expand


def _search_leaf(_key, targets: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
    """Targets of a group with the best triangle that the points of one leaf allow."""
    if not len(targets):
        return pd.DataFrame(columns=[*STATE, "changed", *NEW_IDS, *NEW_XS, *NEW_YS])
    ids, vx, vy = _improve_blocks(
        targets, points["pid"].to_numpy(), points["px"].to_numpy(), points["py"].to_numpy()
    )
    out = targets[STATE].copy()
    out["changed"] = (ids != targets[IDS].to_numpy()).any(axis=1)
    for k in range(3):
        out[NEW_IDS[k]], out[NEW_XS[k]], out[NEW_YS[k]] = ids[:, k], vx[:, k], vy[:, k]
    return out


def _merge_candidates(batches):
    """mapInPandas function: best triangle over the vertices proposed by all visited leaves."""
    for pdf in batches:
        if not len(pdf):
            continue
        width = pdf["vid"].map(len).max()
        n = len(pdf)
        cid = np.full((n, width), -9, dtype="int64")
        cx, cy = np.full((n, width), np.nan), np.full((n, width), np.nan)
        for i, (vid, px, py) in enumerate(zip(pdf["vid"], pdf["vpx"], pdf["vpy"])):
            cid[i, : len(vid)], cx[i, : len(vid)], cy[i, : len(vid)] = vid, px, py
        cx = np.where(cid < 0, np.nan, cx)
        ids, vx, vy = improve(
            pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf[IDS].to_numpy(), pdf[XS].to_numpy(),
            pdf[YS].to_numpy(), cid, cx, cy,
        )
        yield _with_basis(pdf, ids, vx, vy)


def _finish(batches):
    """mapInPandas function: vertices and weights of finished targets; outside ones drop out."""
    for pdf in batches:
        if not len(pdf):
            continue
        ids = pdf[IDS].to_numpy()
        _, _, _, w, outside, *_ = _plane(
            pdf["x"].to_numpy(), pdf["y"].to_numpy(), ids, pdf[XS].to_numpy(), pdf[YS].to_numpy()
        )
        w = np.where(ids < 0, 0.0, w)
        w = w / np.where(outside, 1.0, w.sum(axis=1))[:, None]
        # a target on the outer edge keeps its two edge points and repeats one with weight 0
        ids = np.where(ids < 0, ids.max(axis=1)[:, None], ids)
        keep = ~outside
        cell = pdf["cell"].to_numpy()[keep]
        yield pd.DataFrame(
            {
                "cell": np.repeat(cell, 3),
                "k": np.tile(np.arange(3, dtype="int32"), len(cell)),
                "pid": ids[keep].ravel(),
                "w": w[keep].ravel(),
            }
        )


def _one_round(
    visits: DataFrame, leaf_points: DataFrame, boxes: np.ndarray, tasks: int
) -> tuple[DataFrame, DataFrame]:
    """Search the visited leaves; returns finished targets and the visits of the next round.

    Partition counts are explicit: the searches are heavy for the few bytes they move, and adaptive
    execution, which sizes partitions by bytes, would put them into too few tasks.
    """
    untouched = visits.filter("leaf is null").select(STATE)
    visits = visits.filter("leaf is not null")
    # crowded leaves are split over several groups, each with a copy of the leaf's points
    groups = visits.groupBy("leaf").agg(F.ceil(F.count("*") / TARGETS_PER_GROUP).alias("n_groups"))
    salted_visits = visits.join(groups, "leaf").withColumn(
        "salt", F.pmod(F.xxhash64("cell"), F.col("n_groups")).cast("int")
    )
    salted_points = leaf_points.join(groups, "leaf").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("n_groups").cast("int") - 1))
    )
    searched = (
        salted_visits.select(*STATE, "leaf", "salt")
        .repartition(tasks, "leaf", "salt")
        .groupBy("leaf", "salt")
        .cogroup(
            salted_points.select("pid", "px", "py", "leaf", "salt").repartition(tasks, "leaf", "salt").groupBy("leaf", "salt")
        )
        .applyInPandas(_search_leaf, SEARCH_SCHEMA)
    )
    triangle = F.array(
        *[
            F.struct(F.col(i).alias("id"), F.col(x).alias("px"), F.col(y).alias("py"))
            for i, x, y in zip(NEW_IDS, NEW_XS, NEW_YS)
        ]
    )
    # proposals per target are bounded by the number of leaves it visited
    gathered = cut_lineage(
        searched.repartition(tasks, "cell")
        .groupBy("cell")
        .agg(
            F.any_value(F.struct(*STATE[1:])).alias("own"),
            F.flatten(F.collect_list(F.when(F.col("changed"), triangle))).alias("found"),
        )
    )
    finished = gathered.filter("size(found) = 0").select("cell", "own.*").unionByName(untouched)
    improved = gathered.filter("size(found) > 0").select(
        "cell", "own.*", F.col("found.id").alias("vid"), F.col("found.px").alias("vpx"), F.col("found.py").alias("vpy")
    )
    moved = improved.mapInPandas(_merge_candidates, STATE_SCHEMA)
    return finished, cut_lineage(moved.mapInPandas(_touched_leaves(boxes), VISIT_SCHEMA))


def triangulated_weights(
    points: DataFrame,
    zoom: int,
    grid_id: str,
    wrap: bool | None = None,
    cells: DataFrame | None = None,
    points_per_leaf: int = 4096,
) -> DataFrame:
    """Weights from any set of points ``(src_idx, lon, lat)`` to the cells of ``zoom``.

    Planar longitude/latitude degrees are the metric. With ``wrap`` (default: longitudes span at
    least 359 degrees) points are repeated one turn to either side. Cells outside the convex hull
    get no rows. The driver sees the quadtree and one row per block, ``MAX_BLOCKS`` or so for any number of
    points, and one row of extremes.
    """
    spark = points.sparkSession
    unique = one_per_location(points)
    stats = unique.agg(
        F.count("*").alias("n"), F.min("lon").alias("x_lo"), F.max("lon").alias("x_hi"),
        F.min("lat").alias("y_lo"), F.max("lat").alias("y_hi"),
    ).first()
    if stats.n < 3:
        raise ValueError("a triangulation needs three different points")
    wrap = stats.x_hi - stats.x_lo >= 359 if wrap is None else wrap
    placed = shifted_copies(unique) if wrap else unique.withColumn("copy", F.lit(1))
    placed = placed.select(
        (F.col("src_idx") * 3 + F.col("copy")).alias("pid"), F.col("lon").alias("px"), F.col("lat").alias("py")
    )
    pad = 360.0 if wrap else 0.0
    box = (stats.x_lo - pad, stats.x_hi + pad, stats.y_lo, stats.y_hi)
    n_placed = stats.n * (3 if wrap else 1)
    blocks = split_nodes(placed, box, n_placed, max(points_per_leaf, n_placed // MAX_BLOCKS))

    def in_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(leaf=blocks.locate(pdf["px"].to_numpy(), pdf["py"].to_numpy()))

    def in_halos(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            row, leaf = blocks.around(pdf["px"].to_numpy(), pdf["py"].to_numpy(), HALO)
            yield pdf.iloc[row].assign(leaf=leaf)

    point_schema = "pid bigint, px double, py double, leaf bigint"
    leaf_points = cut_lineage(placed.mapInPandas(in_leaves, point_schema))
    boxes, angles, extremes, frame = _leaf_facts(leaf_points)
    frame_id = np.array(sorted(frame), dtype="int64")
    frame_x = np.array([frame[i][0] for i in frame_id])
    frame_y = np.array([frame[i][1] for i in frame_id])

    targets = healpix.with_cell_centers(cells if cells is not None else healpix.all_cells(spark, zoom), zoom)
    x = F.col("lon") if wrap else longitude_frame(F.col("lon"), stats.x_lo)
    tasks = 2 * spark.sparkContext.defaultParallelism
    run = min(CELLS_PER_GROUP, max(256, healpix.npix(zoom) // (2 * tasks)))
    targets = targets.select("cell", x.alias("x"), F.col("lat").alias("y"), F.floor(F.col("cell") / run).alias("run"))
    # no point lies beyond the farthest one in a direction, so neither does a covered target
    turn = np.array([[math.cos(t), math.sin(t)] for t in angles]).T
    reach = np.array([far.d + 1e-9 * max(1.0, abs(far.d)) for far in extremes])

    # three placeholder corners well outside everything
    mid_x, mid_y = (box[0] + box[1]) / 2, (box[2] + box[3]) / 2
    size = 8.0 * max(box[1] - box[0], box[3] - box[2], 1.0)
    corner_x = np.array([mid_x - size, mid_x + size, mid_x])
    corner_y = np.array([mid_y - size, mid_y - size, mid_y + size])

    def covered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[(pdf[["x", "y"]].to_numpy() @ turn <= reach).all(axis=1)]
            yield pdf.assign(leaf=blocks.locate(pdf["x"].to_numpy(), pdf["y"].to_numpy()))

    def from_frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield _with_basis(pdf, *_improve_blocks(pdf, frame_id, frame_x, frame_y))

    targets = cut_lineage(targets.mapInPandas(covered, "cell bigint, x double, y double, run bigint, leaf bigint"))
    groups = targets.select(F.col("leaf").alias("leaf"), F.col("run").alias("run")).distinct()
    tasks = max(tasks, groups.count())
    near = leaf_points.drop("leaf").mapInPandas(in_halos, point_schema).join(groups, "leaf")
    searched = cut_lineage(
        targets.repartition(tasks, "leaf", "run").groupBy("leaf", "run")
        .cogroup(near.repartition(tasks, "leaf", "run").groupBy("leaf", "run"))
        .applyInPandas(_search_block(blocks, corner_x, corner_y), STATE_SCHEMA + ", settled boolean")
    )
    finished, rounds = [searched.filter("settled").select(STATE)], 0
    tasks = 2 * spark.sparkContext.defaultParallelism
    left = searched.filter("not settled").select(STATE)
    # where the only block sees all points, what is left lies outside the grid
    if blocks.depth and not left.isEmpty():
        left = left.repartition(tasks, "cell").mapInPandas(from_frame, STATE_SCHEMA)
        visits = cut_lineage(left.mapInPandas(_touched_leaves(boxes), VISIT_SCHEMA))
        while not visits.isEmpty():
            rounds += 1
            done, visits = _one_round(visits, leaf_points, boxes, tasks)
            finished.append(done)
            if rounds > 200:
                raise RuntimeError("triangle search does not settle")
    log.info("triangulated %s points in %s rounds", stats.n, rounds)
    done = finished[0]
    for more in finished[1:]:
        done = done.unionByName(more)
    vertices = done.coalesce(tasks).mapInPandas(_finish, "cell bigint, k int, pid bigint, w double")
    return vertices.select(
        F.lit(grid_id).alias("grid_id"), F.lit(zoom).alias("zoom"), "cell", "k",
        F.floor(F.col("pid") / 3).alias("src_idx"), "w",
    )
