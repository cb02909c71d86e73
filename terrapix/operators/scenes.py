"""Best scene per task: spatio-temporal join with tiered fallback.

Rule: the search tiers are tried in priority order; the first tier with at
least one scene that intersects the task box, falls in the tier's date
window [d0, d1) and has cloud cover strictly below the tier's maximum wins;
inside it the lowest cloud cover wins (ties: lowest scene_id). No hit in any
tier -> no scene (status ``failed_download``).

Plan: tier by tier, (1) the tier's date window and cloud limit filter the scan,
and the scenes of one footprint are reduced to the best one; (2) scenes are laid on
cells a quarter of their level's size; a scene that covers a cell whole meets every
task there, so of the worse scenes in that cell none can win and all leave: what
stays in a cell does not grow with the catalog where scenes are larger than cells;
(3) tasks are laid on the same cells and tested against the scenes that stayed, and
``min(struct(priority, cloud, scene_id))`` per task is a partial aggregation, so a
task or a scene with many candidates never gathers them in one task; (4) the tasks
served leave (left-anti) before the next tier, and tasks without a candidate come
back through a left join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapix.operators.spatial import BOX, box_levels, cell_edges, explode_cells, prefixed
from terrapix.schema import STATUS_FAILED_DOWNLOAD, SearchWindow
from terrapix.session import checkpoint_dir


def _ts(value: str, like: DataFrame, col: str) -> Column:
    return F.lit(value).cast(like.schema[col].dataType)


def scene_tier(scenes: DataFrame, windows: list[SearchWindow], ts: str = "scene_ts",
               cloud: str = "cloud_cover") -> DataFrame:
    """Attach the best (lowest) qualifying tier to each scene; drop the rest."""
    ws = sorted(windows, key=lambda w: w.priority)
    pri = season = None
    for w in ws:
        cond = ((F.col(ts) >= _ts(w.d0, scenes, ts)) & (F.col(ts) < _ts(w.d1, scenes, ts))
                & (F.col(cloud) < F.lit(float(w.max_cloud))))
        pri = F.when(cond, F.lit(w.priority)) if pri is None else pri.when(cond, F.lit(w.priority))
        season = F.when(cond, F.lit(w.season)) if season is None else season.when(cond, F.lit(w.season))
    lo = min(w.d0 for w in ws)
    hi = max(w.d1 for w in ws)
    widest = (F.col(ts) >= _ts(lo, scenes, ts)) & (F.col(ts) < _ts(hi, scenes, ts))
    return (scenes.where(widest)
            .withColumns({"priority": pri, "season": season})
            .where(F.col("priority").isNotNull()))


def _tier_scenes(scenes: DataFrame, w: SearchWindow, ts: str = "scene_ts", cloud: str = "cloud_cover"):
    cond = ((F.col(ts) >= _ts(w.d0, scenes, ts)) & (F.col(ts) < _ts(w.d1, scenes, ts))
            & (F.col(cloud) < F.lit(float(w.max_cloud))))
    return _by_footprint(scenes.where(cond).select("scene_id", "cloud_cover", F.lit(w.priority).alias("priority"),
                                                   F.lit(w.season).alias("season"), *BOX))


def _by_footprint(scenes: DataFrame) -> DataFrame:
    """The best scene of each footprint: overlap depends on the box alone, and
    a catalog repeats the same tiles for years."""
    return (scenes.groupBy(*BOX).agg(F.min(F.struct("priority", "cloud_cover", "scene_id", "season")).alias("b"))
            .select("b.*", *BOX))


def _best(cand: DataFrame) -> DataFrame:
    return (cand.groupBy("task_id")
            .agg(F.min(F.struct("priority", "cloud_cover", "scene_id", "season")).alias("b"))
            .select("task_id", "b.*"))


#: cells of the search along a cell of a box's level
_FINE = 4
_CELL = ["_level", "_cx", "_cy"]


def _winners(tasks: DataFrame, scenes: DataFrame, size: float, levels: list[int]) -> DataFrame:
    """The best scene of each task that has one. ``tasks``: t_ columns; ``scenes``:
    s_ columns, priority, cloud_cover, scene_id, season.

    A pair meets on the higher of its two levels, in a cell that holds a point of
    both boxes; that it may be found in several cells does not change a minimum. A
    scene that is not the best of a task there may be missing, the best never is:
    only a better scene that meets the task as well drops it."""
    rank = F.struct("priority", "cloud_cover", "scene_id", "season")
    laid = explode_cells(scenes, size, levels, "s_", "_sl", _FINE).withColumn("_rank", rank)
    x0, x1, y0, y1 = cell_edges(size, _FINE)
    whole = (F.col("s_xmin") <= x0) & (F.col("s_xmax") >= x1) & (F.col("s_ymin") <= y0) & (F.col("s_ymax") >= y1)
    bound = laid.where(whole).groupBy(*_CELL).agg(F.min("_rank").alias("_bound"))
    kept = laid.join(bound, _CELL, "left").where(F.col("_bound").isNull() | (F.col("_rank") <= F.col("_bound")))
    j = explode_cells(tasks, size, levels, "t_", "_tl", _FINE).join(kept, _CELL)
    hit = ((F.col("s_xmin") <= F.col("t_xmax")) & (F.col("s_xmax") >= F.col("t_xmin"))
           & (F.col("s_ymin") <= F.col("t_ymax")) & (F.col("s_ymax") >= F.col("t_ymin")))
    return _best(j.where(hit))


def match_scenes(tasks: DataFrame, scenes: DataFrame, windows: list[SearchWindow],
                 coarse: float = 50.0, strategy: str = "tiered") -> DataFrame:
    """One row per task: task_id, scene_id, season, priority, cloud_cover, status.

    ``tasks``: task_id, xmin, ymin, xmax, ymax. ``scenes``: scene_id, scene_ts,
    cloud_cover, xmin, ymin, xmax, ymax. ``coarse`` is the join cell size (about
    the scene footprint size keeps the explode factor small on both sides).

    ``strategy="tiered"`` (default) short-circuits like the original search:
    tier k is joined only with the tasks no earlier tier matched (a left-anti
    join), so a large fallback tier never meets tasks that a small preferred
    tier already served. ``"single"`` does one join against every scene's
    best tier; both give the same rows.
    """
    t = tasks.select("task_id", *BOX)
    if strategy == "single":
        s = prefixed(_by_footprint(scene_tier(scenes, windows).select("scene_id", "cloud_cover", "priority", "season", *BOX)), "s_")
        best = _winners(prefixed(t, "t_"), s, coarse, box_levels([(t, ""), (scenes, "")], coarse))
    else:
        # each tier's winners (at most one row per task) are materialised, so
        # the tasks still open after tier k are the tasks minus k small
        # checkpointed tables - a linear plan that never re-runs an earlier
        # tier's join; the checkpoints live in the shared checkpoint folder
        checkpoint_dir(tasks.sparkSession)
        t = t.checkpoint(eager=True)
        remaining, parts = t, []
        levels = box_levels([(t, ""), (scenes, "")], coarse)  # once for all tiers
        for w in sorted(windows, key=lambda x: x.priority):
            s = prefixed(_tier_scenes(scenes, w), "s_")
            b = _winners(prefixed(remaining, "t_"), s, coarse, levels).checkpoint(eager=True)
            parts.append(b)
            remaining = remaining.join(b.select("task_id"), "task_id", "left_anti")
        best = parts[0]
        for b in parts[1:]:
            best = best.unionByName(b)
    return (t.select("task_id").join(best, "task_id", "left")
            .withColumn("status", F.when(F.col("scene_id").isNull(), F.lit(STATUS_FAILED_DOWNLOAD))))
