"""Command line: the four jobs of the pipeline.

  python -m terrapix tasks   --parcels P [--class-map J] [--step S] (--out DIR | --bootstrap B)
  python -m terrapix worker  --parcels P --scenes S (--tasks DIR | --bootstrap B) --out DIR [--res R]
  python -m terrapix monitor (--results DIR | --bootstrap B) --out DIR
  python -m terrapix train   --pixels GLOB --out DIR [--variant v1|v2] [--model PATH]

``--master`` is only for local runs; on a cluster the submitter decides.
Streaming jobs keep their checkpoints below ``--checkpoint``, else ``--out``.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from terrapix.schema import CLASS_MAP, GRID_STEP_DEG, MIN_POLYGONS_TASK


def _session(args):
    from terrapix.session import build_session
    return build_session(args.master, app=f"terrapix-{args.cmd}")


def _class_map(spark, path):
    from terrapix.sources import files
    return files.read_class_map(spark, path) if path else files.class_map_frame(spark, CLASS_MAP)


def cmd_tasks(args) -> dict:
    from terrapix.operators import grid
    from terrapix.sources import files, messages
    spark = _session(args)
    parcels = files.read_parcels(spark, args.parcels, class_column=args.class_column)
    spec = grid.grid_spec(parcels, args.step)
    looked = grid.class_lookup(parcels.select("parcel_id", "ec_hcat_n", "xmin", "ymin", "xmax", "ymax"),
                               _class_map(spark, args.class_map))
    pairs = grid.cell_parcels(looked, spec)
    tasks = grid.make_tasks(grid.cell_counts(pairs), spec, args.min_polygons)
    mapping = {r.ec_hcat_n: r.binary_id for r in _class_map(spark, args.class_map).collect()}
    frames = messages.encode(grid.task_messages(tasks, spec, mapping), messages.task_key())
    if args.bootstrap:
        messages.write_topic(frames, messages.TASKS_TOPIC, args.bootstrap)
    else:
        frames.select("value").write.mode("overwrite").text(args.out)
    stats = grid.dataset_stats(tasks, pairs, spec).first().asDict()
    stats["grid"] = [spec.nx, spec.ny]
    print(json.dumps(stats, default=str))
    return stats


def _checkpoint(args, name: str) -> str:
    """A stream's own folder: below --checkpoint, else below --out."""
    return f"{(args.checkpoint or args.out).rstrip('/')}/_checkpoint_{name}"


def cmd_worker(args):
    from terrapix.operators import grid
    from terrapix.schema import windows_from_intervals
    from terrapix.sources import files, messages
    from terrapix.streaming.patch_stream import run_patch_stream
    spark = _session(args)
    parcels = grid.class_lookup(files.read_parcels(spark, args.parcels, class_column=args.class_column),
                                _class_map(spark, args.class_map))
    scenes = files.read_scenes(spark, args.scenes)
    stream = messages.read_task_stream(spark, args.bootstrap, args.tasks)
    q = run_patch_stream(stream, parcels, scenes, windows_from_intervals(), args.out, _checkpoint(args, "worker"),
                         res=args.res, parcel_cell=args.parcel_cell, scene_cell=args.scene_cell,
                         worker_id=args.worker_id, available_now=args.once,
                         processing_time=None if args.once else "1 second", kafka_bootstrap=args.bootstrap,
                         rasters=files.read_rasters(spark, args.rasters) if args.rasters else None,
                         n_bands=args.bands, utm_zone=args.utm_zone)
    q.awaitTermination()


def cmd_monitor(args):
    from terrapix.sources import messages
    from terrapix.streaming.monitor_stream import run_monitor_stream
    from terrapix.streaming.progress_stream import run_progress_stream, run_to_end
    spark = _session(args)
    stream = messages.valid(messages.read_result_stream(spark, args.bootstrap, args.results))
    q1 = run_monitor_stream(stream, f"{args.out}/monitor", _checkpoint(args, "monitor"), available_now=args.once,
                            processing_time=None if args.once else "5 seconds")
    q2 = run_progress_stream(stream, f"{args.out}/progress", _checkpoint(args, "progress"), every=args.every, available_now=args.once)
    try:
        q1.awaitTermination()
    finally:  # also when interrupted
        run_to_end(q2, f"{args.out}/progress", None if args.once else 1.0)


def cmd_train(args) -> dict:
    from terrapix.operators import features as feat
    from terrapix.operators import ml
    from terrapix.plans.training import train_and_evaluate
    from terrapix.sources import files
    spark = _session(args)
    t0 = time.time()
    pixels = files.read_pixels(spark, args.pixels)
    forest = ml.FOREST_V1 if args.variant == "v1" else ml.FOREST_V2
    if args.trees or args.depth:
        forest = ml.ForestParams(args.trees or forest.num_trees, args.depth or forest.max_depth,
                                 forest.subsampling_rate, forest.impurity, forest.feature_subset, forest.seed)
    feats = feat.FEATURES_V1 if args.variant == "v1" else feat.FEATURES_V2
    res = train_and_evaluate(pixels, forest=forest, features=feats,
                             fractions={1: args.crop_fraction, 0: args.noncrop_fraction}, seed=args.seed)
    conf = spark.createDataFrame(res.confusion, "label double, prediction double, count long")
    ml.write_report_csv(conf, f"{args.out}/confusion_matrix")
    imp = spark.createDataFrame(res.importances, "feature string, importance double")
    ml.write_report_csv(imp, f"{args.out}/feature_importance")
    if args.model:
        ml.save_model(res.model, args.model)
    out = {"timings": res.timings, "balanced": res.counts["balanced"], "metrics": res.metrics,
           "total_sec": time.time() - t0}
    print(json.dumps(out, default=str))
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="terrapix")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("tasks", help="parcels -> grid tasks (+ statistics)")
    t.add_argument("--parcels", required=True)
    t.add_argument("--class-map", default=None)
    t.add_argument("--class-column", default="EC_hcat_n")
    t.add_argument("--step", type=float, default=GRID_STEP_DEG)
    t.add_argument("--min-polygons", type=int, default=MIN_POLYGONS_TASK)
    t.add_argument("--out")
    t.add_argument("--bootstrap")
    t.set_defaults(fn=cmd_tasks)

    w = sub.add_parser("worker", help="task stream -> results, ready events")
    w.add_argument("--parcels", required=True)
    w.add_argument("--scenes", required=True)
    w.add_argument("--class-map", default=None)
    w.add_argument("--class-column", default="EC_hcat_n")
    w.add_argument("--tasks")
    w.add_argument("--bootstrap")
    w.add_argument("--out", required=True)
    w.add_argument("--checkpoint", default=None)
    w.add_argument("--res", type=float, required=True)
    w.add_argument("--parcel-cell", type=float, default=GRID_STEP_DEG)
    w.add_argument("--scene-cell", type=float, default=1.0)
    w.add_argument("--worker-id", default="spark")
    w.add_argument("--rasters", default=None, help="raster table: task_id, h, w, bands")
    w.add_argument("--bands", type=int, default=10)
    w.add_argument("--utm-zone", type=int, default=None, help="project before burning; --res is in metres then")
    w.add_argument("--once", action="store_true", help="process what is available, then stop")
    w.set_defaults(fn=cmd_worker)

    m = sub.add_parser("monitor", help="result stream -> per-worker counters, totals, snapshots")
    m.add_argument("--results")
    m.add_argument("--bootstrap")
    m.add_argument("--out", required=True)
    m.add_argument("--checkpoint", default=None)
    m.add_argument("--every", type=int, default=20)
    m.add_argument("--once", action="store_true")
    m.set_defaults(fn=cmd_monitor)

    r = sub.add_parser("train", help="pixel table -> balanced split -> forest -> metrics, reports, model")
    r.add_argument("--pixels", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--variant", choices=["v1", "v2"], default="v1")
    r.add_argument("--model", default=None)
    r.add_argument("--trees", type=int, default=None)
    r.add_argument("--depth", type=int, default=None)
    r.add_argument("--crop-fraction", type=float, default=0.1)
    r.add_argument("--noncrop-fraction", type=float, default=0.025)
    r.add_argument("--seed", type=int, default=42)
    r.set_defaults(fn=cmd_train)
    return p


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    if args.cmd == "tasks" and not (args.out or args.bootstrap):
        print("tasks: give --out or --bootstrap", file=sys.stderr)
        return 2
    args.fn(args)
    return 0
