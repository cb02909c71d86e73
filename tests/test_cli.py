"""The command line jobs on small derived inputs."""

import json
import os

from pyspark.sql import functions as F

from terrapix import cli
from terrapix.sources import derived
from tests.conftest import SF_SMALL


def test_cli_tasks_and_train(spark, tmp_dir, capsys):
    parcels = os.path.join(tmp_dir, "parcels")
    derived.parcels(spark, SF_SMALL).write.parquet(parcels)
    cm = os.path.join(tmp_dir, "classes.json")
    with open(cm, "w") as fh:
        json.dump(derived.FIXTURE_CLASS_MAP, fh)
    out = os.path.join(tmp_dir, "tasks")
    assert cli.main(["tasks", "--parcels", parcels, "--class-map", cm, "--step", "20",
                     "--class-column", "ec_hcat_n", "--out", out]) == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    lines = spark.read.text(out)
    assert lines.count() == stats["n_tasks"] > 0
    first = json.loads(lines.first().value)
    assert set(first) >= {"task_id", "bbox", "grid_step", "polygon_count", "binary_distribution", "binary_classes"}

    pixels = os.path.join(tmp_dir, "pixels")
    derived.pixels(spark, SF_SMALL).write.parquet(pixels)
    rep = os.path.join(tmp_dir, "report")
    assert cli.main(["train", "--pixels", pixels, "--out", rep, "--trees", "3", "--depth", "3",
                     "--model", os.path.join(tmp_dir, "model")]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert 0 <= res["metrics"]["auc"] <= 1
    conf = spark.read.option("header", True).csv(os.path.join(rep, "confusion_matrix"))
    assert conf.agg(F.sum(F.col("count").cast("long"))).first()[0] > 0
    assert os.path.isdir(os.path.join(tmp_dir, "model"))


def test_cli_worker_and_monitor_once(spark, tmp_dir):
    from terrapix.operators import grid
    from terrapix.plans import queries as Q
    from terrapix.sources import messages
    parcels = os.path.join(tmp_dir, "parcels")
    derived.parcels(spark, SF_SMALL).write.parquet(parcels)
    scenes = os.path.join(tmp_dir, "scenes")
    derived.scenes(spark, SF_SMALL).write.parquet(scenes)
    tasks, _, spec = Q.task_pairs(spark, SF_SMALL, with_rings=False)
    tdir = os.path.join(tmp_dir, "tasks")
    messages.write_json_lines(messages.encode(grid.task_messages(tasks, spec, derived.FIXTURE_CLASS_MAP)), tdir)
    cm = os.path.join(tmp_dir, "classes.json")
    with open(cm, "w") as fh:
        json.dump(derived.FIXTURE_CLASS_MAP, fh)
    out = os.path.join(tmp_dir, "worker")
    assert cli.main(["worker", "--parcels", parcels, "--scenes", scenes, "--class-map", cm,
                     "--class-column", "ec_hcat_n", "--tasks", tdir, "--out", out, "--res", "1",
                     "--parcel-cell", "20", "--scene-cell", "50", "--once",
                     "--checkpoint", os.path.join(tmp_dir, "ck1")]) == 0
    res = spark.read.parquet(os.path.join(out, "results"))
    assert res.count() == tasks.count()
    rdir = os.path.join(tmp_dir, "results_json")
    messages.write_json_lines(messages.encode(derived.task_results(spark, SF_SMALL)
                                              .withColumn("ts", F.col("ts").cast("timestamp"))), rdir)
    mout = os.path.join(tmp_dir, "monitor")
    assert cli.main(["monitor", "--results", rdir, "--out", mout, "--once",
                     "--checkpoint", os.path.join(tmp_dir, "ck2")]) == 0
    tot = spark.read.parquet(os.path.join(mout, "monitor", "snapshots")).orderBy(F.col("batch").desc()).first()
    assert tot.tasks == derived.task_results(spark, SF_SMALL).count()
    assert spark.read.parquet(os.path.join(mout, "progress", "snapshots")).count() == tot.tasks // 20
