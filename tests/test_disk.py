"""What a run of the stored flow holds on disk: no shuffle files of queries that ended, some of the buckets at a time."""
from __future__ import annotations

import glob
import os
import re
import time

from pyspark.sql import functions as F

from postings_lake.operators import marts
from postings_lake.operators.curate import BRONZE_SCHEMA, CurateSpec, curate
from postings_lake.plans import flow
from postings_lake.sources import commits, tables
from postings_lake.sources.tables import Layout


def bronze(spark, ids, at, version=0):
    """Three copies of every posting of ``ids``; their last one counts."""
    n = F.col("id")
    rows = spark.range(3 * len(ids)).select((n % len(ids) + ids.start).alias("id"), F.floor(n / len(ids)).cast("int").alias("copy"))
    made = {"source_id": n.cast("string"), "source_name": F.when(n % 3 == 0, "feed_b").when(n % 3 == 1, "adzuna"), "title": F.lit(" Junior Data Engineer "),
            "company": F.concat(F.lit(" C"), ((n + version) % 5).cast("string")), "country_code": F.when(n % 4 > 0, F.lit(" DE")).otherwise("nl "), "description": F.lit("Python on AWS"),
            "created": F.concat(F.lit("2026-06-0"), (1 + n % 9).cast("string"), F.lit("T09:00:00Z")), "ingested_at": F.concat(F.lit(at), F.col("copy").cast("string"))}
    return rows.select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields])


def rows(df):
    return sorted(map(repr, df.collect()))


def like_a_rebuild(spark, lay, spec=CurateSpec()):
    want = curate(tables.read_bronze(spark, lay, digest=True), spec).drop("row_digest")
    assert rows(tables.read_silver(spark, lay)) == rows(want)
    for s in flow.PUBLISHED:
        assert rows(tables.read_mart(spark, lay, s.name)) == rows(marts.build_mart(want, s)), s.name


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data") if os.path.getsize(f) > 0}


def test_shuffle_files_go_with_the_write(spark, workdir):
    df = spark.range(50_000).select("id", (F.col("id") % 7).alias("bucket"), F.lit("2026-06-01").cast("date").alias("posted_date"))
    before = shuffle_files(spark)
    folder, n = tables.write_folder(df, workdir, "parquet", ["bucket"])
    for _ in range(20):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert n == 50_000 and spark.read.parquet(f"{workdir}/{folder}").count() == n
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) != "true"  # the caller's session


def test_rows_held_in_the_callers_session_are_not_computed_again(spark):
    held = spark.range(100).where("id > 5").persist()
    try:
        assert "InMemoryTableScan" in tables.released(held)._jdf.queryExecution().executedPlan().toString()
    finally:
        held.unpersist()


def test_passes_over_buckets_equal_a_rebuild_and_bound_what_is_staged(spark, workdir, monkeypatch):
    monkeypatch.setattr(flow, "ROWS_A_PASS", 200, raising=False)
    monkeypatch.setattr(flow, "ROWS_A_BUCKET", 25, raising=False)
    lay, staged, write = Layout(workdir), [], tables.observed_write

    def seen(df, path, mode, fmt, options, by=()):
        n = write(df, path, mode, fmt, options, by)
        if path.startswith(lay.silver):
            staged.append(n)
        return n

    monkeypatch.setattr(tables, "observed_write", seen)
    for k, ids in enumerate((range(0, 200), range(150, 330))):
        tables.append_bronze(bronze(spark, ids, f"2026-06-1{k}T00:00:0", k), lay, f"batch-{k}")
        flow.update(spark, lay, gate_key=("source_name", "source_id"))
        like_a_rebuild(spark, lay)
        assert len(staged) > 1 and max(staged) <= 150  # of 200 postings, then of 180 and those they replace
        del staged[:]
    now = tables.latest(spark, lay)
    assert now.buckets == 24 and now.silver_rows == 330


def test_passes_keep_copies_together_whose_key_is_normalised(spark, workdir, monkeypatch):
    monkeypatch.setattr(flow, "ROWS_A_PASS", 50, raising=False)
    lay, spec = Layout(workdir), CurateSpec(key=("source_id", "company", "country_code"))
    for k in range(2):
        tables.append_bronze(bronze(spark, range(40), f"2026-06-1{k}T00:00:0"), lay, f"batch-{k}")
        flow.update(spark, lay, spec=spec, gate_key=("source_id",), buckets=32)
    assert tables.latest(spark, lay).buckets == 32
    for b, folders in tables.latest(spark, lay).silver.items():
        for f in folders:
            part = spark.read.schema(tables.stored_silver(spark, lay, tables.latest(spark, lay)).schema).parquet(f"{lay.silver}/{f}")
            assert [r[0] for r in part.select(tables.bucket_of(spec.key, 32)).distinct().collect()] == [int(b)]
    assert tables.read_silver(spark, lay).count() == 40


def test_few_rows_or_buckets_take_one_pass(spark):
    df = bronze(spark, range(5), "2026-06-01T00:00:0")
    assert flow.passes(df, 15, CurateSpec(), 16) == [df] and flow.passes(df, 1 << 40, CurateSpec(), 15) == [df]
    parts = flow.passes(df, 1 << 40, CurateSpec(), 32)
    assert len(parts) == 4 and sum(p.count() for p in parts) == 15


def test_bronze_stores_no_digests_and_rows_that_left_are_dropped(spark, workdir):
    lay = Layout(workdir)
    for k in range(2):
        tables.append_bronze(bronze(spark, range(20), f"2026-06-1{k}T00:00:0", k), lay, f"batch-{k}")
        flow.update(spark, lay, gate_key=("source_name", "source_id"))
    like_a_rebuild(spark, lay)
    assert all(spark.read.parquet(d).schema == BRONZE_SCHEMA for d in glob.glob(f"{lay.bronze}/*"))
    assert not [f for f in glob.glob(f"{lay.silver}/**/part-*", recursive=True) if re.search("weight=-1", f)]
    assert commits.numbers(spark, lay.snapshots) == [1, 2]


def test_files_are_compressed_well(spark, workdir):
    import pyarrow.parquet as pq

    df = bronze(spark, range(2000), "2026-06-01T00:00:0")
    tables.append_bronze(df, Layout(workdir))
    tables.replace_table(df, f"{workdir}/plain", "json")  # other formats as Spark writes them
    (f, *_) = glob.glob(f"{workdir}/bronze/jobs/*/part-*.parquet")
    assert pq.ParquetFile(f).metadata.row_group(0).column(1).compression == "ZSTD"
    assert spark.read.json(f"{workdir}/plain").count() == tables.read_bronze(spark, Layout(workdir)).count() == 6000
