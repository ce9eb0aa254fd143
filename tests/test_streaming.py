"""Incremental bronze ingest from landed page files."""
from __future__ import annotations

import json
import os

from postings_lake.operators.curate import curate
from postings_lake.sources import tables
from postings_lake.sources.tables import Layout
from postings_lake.streaming import start_bronze_stream


def land(spark, directory, name, at, pages):
    rows = [(c, p, json.dumps({"results": [{"id": i, "title": "Data Engineer",
                                            "created": "2026-06-01T09:00:00Z"} for i in ids]}), at)
            for c, p, ids in pages]
    df = spark.createDataFrame(rows, "country string, page bigint, body string, ingested_at string")
    df.coalesce(1).write.json(os.path.join(directory, name))


def test_stream_appends_only_new_files(spark, workdir):
    landing_dir = os.path.join(workdir, "landing")
    lay = Layout(os.path.join(workdir, "lake"))
    ckpt = os.path.join(workdir, "ckpt")
    land(spark, landing_dir, "run1", "2026-06-01T00:00:00Z", [("de", 1, [1, 2]), ("de", 2, []), ("de", 3, [9])])
    q = start_bronze_stream(spark, landing_dir + "/*", lay, checkpoint=ckpt)
    q.awaitTermination(120)
    assert tables.read_table(spark, lay.bronze).count() == 2  # cut off at the empty page 2

    land(spark, landing_dir, "run2", "2026-06-02T00:00:00Z", [("nl", 1, [1, 3])])
    q = start_bronze_stream(spark, landing_dir + "/*", lay, checkpoint=ckpt)
    q.awaitTermination(120)
    bronze = tables.read_table(spark, lay.bronze)
    assert bronze.count() == 4  # run1 is not read again
    silver = {(r["source_id"], r["country_code"]) for r in curate(bronze).collect()}
    assert silver == {("1", "nl"), ("2", "de"), ("3", "nl")}


def test_backlog_of_several_runs_in_one_batch(spark, workdir):
    folder, lay = os.path.join(workdir, "landing"), Layout(os.path.join(workdir, "lake"))
    land(spark, folder, "run1", "2026-06-01T00:00:00Z", [("de", 1, [1]), ("de", 2, []), ("de", 3, [7])])
    land(spark, folder, "run2", "2026-06-02T00:00:00Z", [("de", 1, [2]), ("de", 2, [3]), ("de", 3, [4]), ("de", 4, [5])])
    start_bronze_stream(spark, folder + "/*", lay, checkpoint=os.path.join(workdir, "ckpt")).awaitTermination(120)
    assert sorted(r["source_id"] for r in tables.read_bronze(spark, lay).collect()) == ["1", "2", "3", "4", "5"]


def test_two_folders_have_two_checkpoints(spark, workdir):
    lays = []
    for name in ("north", "south"):
        folder, lay = os.path.join(workdir, name), Layout(os.path.join(workdir, "lake", name))
        land(spark, folder, "run1", "2026-06-01T00:00:00Z", [("de", 1, [1, 2])])
        start_bronze_stream(spark, folder + "/*", lay).awaitTermination(120)
        lays.append(lay)
    assert [tables.read_bronze(spark, lay).count() for lay in lays] == [2, 2]


def test_stream_names_are_stable_and_distinct():
    from postings_lake.streaming.bronze_stream import stream_id

    a, b = stream_id("/in/a", Layout("/lake")), stream_id("/in/b", Layout("/lake"))
    assert a != b and a != stream_id("/in/a", Layout("/lake2")) and a == "bronze_" + a.removeprefix("bronze_")
    assert stream_id("/in/a", Layout("/lake")) == a
