"""Batches of many rows are not broadcast, however small their files look."""

from pyspark.sql import functions as F
from test_layout import plan_of, small  # noqa: F401
from test_sources import write_lines

from snapstats.operators.keyed import replace_by_parent, rows_missing
from snapstats.plans import jobs
from snapstats.sources import tables

ROWS = 100_002


def test_well_packed_ids_are_not_broadcast(spark, folder, rows):
    wide = [F.lit(None).cast("string").alias(f"c{k}") for k in range(20)]
    ids = spark.range(ROWS).select(F.format_string("v%08d", "id").alias("video_id"), *wide)
    batch = jobs.Run(spark, "r", f"{folder}/runs").staged("batch", ids)
    spark.createDataFrame([("v00000001",), ("w",), (None,)], "video_id string").write.parquet(f"{folder}/current")
    current = spark.read.parquet(f"{folder}/current")
    left, new = replace_by_parent(current, batch.limit(0), "video_id", batch), rows_missing(batch.select("video_id"), current, ["video_id"])
    for joined in (left, new):
        assert "SortMergeJoin" in plan_of(joined) and "BroadcastHashJoin" not in plan_of(joined)
    assert rows(left, "video_id") == [("w",), (None,)]
    assert new.count() == ROWS - 1


def test_small_batches_may_be_broadcast(spark, folder):
    batch = jobs.Run(spark, "r", f"{folder}/runs").staged("batch", spark.range(10))
    assert "BroadcastHashJoin" in plan_of(rows_missing(batch, spark.range(1000), ["id"]))


def test_large_landing_broadcasts_no_batch(spark, small, folder, rows, monkeypatch):  # noqa: F811
    """Two runs, the second of them twice, over videos only, as in `j01_landing_runs`."""
    monkeypatch.setattr(jobs, "SORTED_ROWS", 1, raising=False)
    plans, plain = [], type(spark.range(0)).join

    def join(self, other, on=None, how=None):
        joined = plain(self, other, on, how)
        plans.append(plan_of(joined))
        return joined
    monkeypatch.setattr(type(spark.range(0)), "join", join)
    runs = []
    for k, videos in enumerate((6, 4), 1):
        path = f"{folder}/landing-{k}"
        write_lines(path, "1.json", [{"id": f"v{i}", "snippet": {"channelId": f"c{i % 3}", "title": f"run {k}", "description": "0:00 Start"},
                                      "statistics": {"viewCount": str(i * k)}} for i in range(videos)] + ["{broken"])
        runs.append((jobs.Run(spark, f"run-{k}", f"{folder}/runs", small, f"2026-01-0{k} 06:00:00"), {"video": path}))
    for run, landing in (*runs, runs[1]):
        jobs.apply_landing(run, landing, resumable=True)
    assert plans and not [p for p in plans if "BroadcastHashJoin" in p]
    table = {name: tables.load_catalog(spark, small, [name])[name] for name in ("videos", "video_stats", "chapters", "fetch_log", "fetch_progress")}
    assert rows(table["videos"], "video_id", "title") == [(f"v{i}", "run 2" if i < 4 else "run 1") for i in range(6)]
    assert rows(table["video_stats"], "video_id", F.dayofmonth("fetched_at"), "view_count") == sorted(
        [(f"v{i}", 1, i) for i in range(6)] + [(f"v{i}", 2, 2 * i) for i in range(4)])
    assert rows(table["chapters"], "video_id", "title") == [(f"v{i}", "Start") for i in range(6)]
    assert rows(table["fetch_log"], "channel_id", "fetch_type", "videos_fetched") == sorted(
        [(f"c{i}", "backfill", 2) for i in range(3)] + [("c0", "incremental", 2), ("c1", "incremental", 1), ("c2", "incremental", 1)])
    assert rows(table["fetch_progress"], "channel_id", "video_id") == sorted((f"c{i % 3}", f"v{i}") for i in range(6))
