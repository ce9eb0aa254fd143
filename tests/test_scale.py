"""Work that must not pile up in one task or cross the network in full, whatever the layout of the input."""
from __future__ import annotations

import re

from pyspark.sql import functions as F

from postings_lake.operators import curate, marts, tagging
from postings_lake.plans import fixtures, flow


def lineitem(spark, folder, rows):
    spark.range(0, rows, 1, 1).select(
        (F.col("id") / 2).cast("long").alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"),
        (F.col("id") % 4).cast("int").alias("l_linenumber"), (F.col("id") * 1.5).alias("l_extendedprice"), F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.lit("1996-01-02").cast("date").alias("l_shipdate")).write.parquet(f"{folder}/lineitem.parquet")


def test_one_row_group_is_dealt_out_over_tasks(spark, workdir, monkeypatch):
    lineitem(spark, workdir, 6000)
    monkeypatch.setattr(fixtures, "TASK_BYTES", 8 << 10, raising=False)
    got = fixtures.load_postings(spark, workdir)
    sizes = [len(p) for p in got.rdd.glom().collect()]
    assert len(sizes) > 3 and max(sizes) < 2 * 6000 / len(sizes)
    plain = fixtures.postings(fixtures.table(spark, workdir, "lineitem"))
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_ngrams_of_texts_meet_a_small_taxonomy_without_a_shuffle(spark):
    df = spark.createDataFrame([(i, f"python and word{i}") for i in range(50)], "id long, text string")  # of unknown size
    tagged = tagging.with_tags(df, ("id",), F.col("text"), {"Python": ("python",), "SQL": ("sql", "s q l")})
    plan = tagged._jdf.queryExecution().sparkPlan().toString()
    assert "Generate explode" in plan and "hashpartitioning(gram" not in plan
    assert "BroadcastHashJoin [gram" in plan
    assert {tuple(r["skills"]) for r in tagged.collect()} == {("Python",)}


def longest_method(df):
    """Bytecodes of the longest method that the plan's code holds."""
    codegen = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(codegen))))


def test_counts_and_changes_run_in_methods_that_the_jvm_compiles(spark, workdir):
    """The JVM leaves methods of more than 8,000 bytecodes to its interpreter."""
    lineitem(spark, workdir, 400)
    rows = fixtures.table(spark, workdir, "lineitem")
    for k in (0, 1):
        curate.curate(curate.with_digest(fixtures.postings(rows.where(f"l_linenumber % 2 = {k}")))).write.parquet(f"{workdir}/{k}")
    old, new = (spark.read.parquet(f"{workdir}/{k}") for k in (0, 1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts, signed = marts.tagged_counts(old, flow.PUBLISHED), curate.changes(old, new)
        assert longest_method(counts) < 8000
        assert longest_method(signed) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for i, spec in enumerate(flow.PUBLISHED):
        got = sorted(map(str, counts.where(F.col("__mart") == i).select(*spec.keys, "__n").collect()))
        assert got == sorted(map(str, marts.build_mart(old, spec, ordered=False).withColumnRenamed(spec.measure, "__n").collect()))


def test_counts_of_odd_rows(spark):
    """Null arrays, elements, keys and conditions, a key that one mart unnests and another reads, and weights."""
    rows = [(["a", None, "b", "a"], "x", 1, 2), ([], "x", None, 3), (None, "y", 1, 5), (["a"], None, 0, 7), (["b"], "a", None, -1)]
    df = spark.createDataFrame(rows, "tags array<string>, tag string, flag int, weight int")
    unnested = marts.MartSpec("unnested", ("t",), "n", where="flag = 1", explode=("tags", "t"))
    both = marts.MartSpec("both", ("tag", "t"), "n", explode=("tags", "t"))
    read = marts.MartSpec("read", ("tag",), "n", where="flag is null or flag < 2")
    got = marts.tagged_counts(df, (unnested, both, read)).select("__mart", "t", "tag", "__n").collect()
    assert {tuple(r) for r in got} == {(0, "a", None, 2), (0, "b", None, 1), (1, "a", "x", 2), (1, "b", "x", 1), (1, "a", None, 1),
                                       (1, "b", "a", 1), (2, None, "x", 2), (2, None, "y", 1), (2, None, "a", 1)}
    got = marts.tagged_counts(df, (unnested, read), "weight").select("__mart", "t", "tag", "__n").collect()
    assert {tuple(r) for r in got} == {(0, "a", None, 4), (0, "b", None, 2), (1, None, "x", 5), (1, None, "y", 5), (1, None, "a", -1)}
