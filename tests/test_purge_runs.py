"""Purge runs: one join per table, only parts that lose rows are replaced, repeated runs mend."""

import datetime as dt
import os

import pytest
from test_layout import files_of, small  # noqa: F401

from snapstats.operators import maintenance
from snapstats.plans import jobs
from snapstats.sources import tables

OLD, NEW = dt.datetime(2025, 1, 5), dt.datetime(2025, 6, 5)
LATER = "2026-01-01 00:00:00"


@pytest.fixture
def filled(spark, small):  # noqa: F811
    """40 videos, v0 to v9 deleted long ago. Those have snapshots of the old month only, the others of both; one video comes twice,
    some snapshots and the only comment have no time."""
    videos = [(f"v{i}", "deleted" if i < 10 else "public", OLD) for i in range(40)] + [("v3", "deleted", OLD)]
    tables.append("videos", spark.createDataFrame(videos, "video_id string, privacy_status string, updated_at timestamp"), small)
    stats = [(f"v{i}", at, i) for i in range(40) for at in (OLD, NEW) if at == OLD or i >= 10] + [("v2", None, 0), ("v20", None, 0)]
    tables.append("video_stats", spark.createDataFrame(stats, "video_id string, fetched_at timestamp, view_count bigint"), small)
    tables.append("transcripts", spark.createDataFrame([("v30", "text")], "video_id string, full_text string"), small)
    tables.append("comments", spark.createDataFrame([("c1", "v5")], "comment_id string, video_id string"), small)
    return small


def left(spark, database, name):
    return sorted(r[0] for r in tables.load_catalog(spark, database, [name])[name].select("video_id").collect())


@pytest.mark.parametrize("hashed", [jobs.HASHED_IDS, 2])
def test_purge_joins_each_table_once(spark, filled, folder, monkeypatch, hashed):
    monkeypatch.setattr(jobs, "HASHED_IDS", hashed)
    joins, plain = [], type(spark.range(0)).join
    monkeypatch.setattr(type(spark.range(0)), "join", lambda self, other, on=None, how=None: joins.append(how) or plain(self, other, on, how))
    before = files_of(spark, f"{filled}.video_stats")
    run = jobs.Run(spark, "r1", f"{folder}/runs", filled, LATER)
    counts = {r["table"]: r["purged"] for r in jobs.purge(run).collect()}
    assert joins == ["left_anti"] * len(maintenance.VIDEO_TABLES)
    assert counts == {"videos": 11, "video_stats": 11, "transcripts": 0, "chapters": 0, "comments": 1, "video_comment_summary": 0}
    kept = sorted(f"v{i}" for i in range(10, 40))
    assert left(spark, filled, "videos") == kept and left(spark, filled, "video_stats") == sorted([*kept * 2, "v20"])
    assert left(spark, filled, "transcripts") == ["v30"] and left(spark, filled, "comments") == []
    # The month that lost nothing keeps its files.
    later = {f: t for f, t in before.items() if "fetched_month=2025-06-01" in f}
    assert later and later.items() <= files_of(spark, f"{filled}.video_stats").items()


def test_repeated_purge_mends(spark, filled, folder):
    run, before = jobs.Run(spark, "r1", f"{folder}/runs", filled, LATER), files_of(spark, f"{filled}.video_stats")
    first = sorted(map(tuple, jobs.purge(run).collect()))
    want = left(spark, filled, "video_stats")
    # As if the first attempt had ended while a part was moved in.
    moved = sorted(f for f in files_of(spark, f"{filled}.video_stats") if f not in before)
    os.remove(moved[0])
    spark.catalog.refreshTable(f"{filled}.video_stats")
    assert left(spark, filled, "video_stats") != want
    assert sorted(map(tuple, jobs.purge(run).collect())) == first and left(spark, filled, "video_stats") == want
