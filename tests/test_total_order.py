"""The order of rows that share key and time: total, and the same however rows come."""
from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from postings_lake.operators.newest import newest_per_key, row_digest

SCHEMA = ("k int, at string, s string, t string, d double, f float, a array<string>, b array<array<string>>, "
          "m map<string,int>, r struct<x:string,y:string,z:array<int>>, n decimal(5,1), u boolean")


def survivors(df):
    return sorted(map(repr, newest_per_key(df, ("k",), "at").collect()))


def digests(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r["d"]) for r in df.select(row_digest(df.schema.fields).alias("d")).collect()]


def test_rows_that_differ_have_different_digests(spark):
    nothing = (1, "t") + (None,) * 10

    def row(**values):
        names = ["s", "t", "d", "f", "a", "b", "m", "r", "n", "u"]
        return (1, "t", *[values.get(n) for n in names])

    rows = [nothing, row(s="x"), row(t="x"), row(s=""), row(t=""), row(s="", t=""), row(d=0.0), row(d=-0.0), row(f=0.0), row(d=float("nan")),
            row(a=[]), row(a=[None]), row(a=[None, None]), row(a=["x", None]), row(a=[None, "x"]), row(a=[""]),
            row(b=[["p"], ["q"]]), row(b=[["p", "q"]]), row(b=[["p", "q"], []]), row(b=[[], ["p", "q"]]), row(b=[None]), row(b=[[]]),
            row(a=["p"], b=[["q"]]), row(a=["p", "q"], b=[]), row(a=["p", "q"]),
            row(m={}), row(m={"a": None}), row(m={"a": 0}), row(m={"a": 0, "b": 1}), row(m={"a": 1, "b": 0}),
            row(r=(None, None, None)), row(r=("x", None, None)), row(r=(None, "x", None)), row(r=(None, None, [])), row(r=(None, None, [None])),
            row(u=False), row(u=True)]
    found = digests(spark, rows, SCHEMA)
    assert len(set(found)) == len(rows)


def test_a_map_has_no_order(spark):
    found = digests(spark, [({"a": 1, "b": 2},), ({"b": 2, "a": 1},)], "m map<string,int>")
    assert found[0] == found[1]


def test_nulls_that_change_places_have_one_survivor(spark):
    rows = [(1, "t", "Berlin", None), (1, "t", None, "Berlin"), (2, "t", None, None), (2, "t", "", None), (2, None, "z", "z")]
    seen = set()
    for n in range(12):
        random.Random(n).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, at string, region string, city string").repartition(1 + n % 4)
        seen.add(tuple(survivors(df)))
    assert len(seen) == 1


texts = st.sampled_from([None, "", "a", "b", "ab"])
lists = st.none() | st.lists(texts, max_size=3)
row = st.tuples(st.integers(0, 2), st.sampled_from([None, "t1", "t2"]), texts, texts, st.sampled_from([None, 0.0, -0.0, 1.5]), st.none(), lists,
                st.none() | st.lists(lists, max_size=2), st.none() | st.dictionaries(st.sampled_from("ab"), st.none() | st.integers(0, 1), max_size=2),
                st.none() | st.tuples(texts, texts, st.none()), st.none(), st.sampled_from([None, True, False]))


@given(st.lists(row, min_size=2, max_size=12), st.randoms(use_true_random=False))
@settings(max_examples=15, deadline=None)
def test_one_survivor_however_rows_come(spark, rows, shuffler):
    first = survivors(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    shuffler.shuffle(rows)
    assert survivors(spark.createDataFrame(rows, SCHEMA).repartition(3)) == first


def test_a_stored_digest_takes_the_place_of_all_columns(spark):
    df = spark.createDataFrame([(1, "t", "x", None), (1, "t", None, "x"), (2, "t", "q", "q")], "k int, at string, s string, t string")
    stored = df.withColumn("digest", row_digest([f for f in df.schema.fields if f.name not in ("k", "at")]))
    whole = newest_per_key(df, ("k",), "at").select("k", "s")
    assert sorted(map(tuple, newest_per_key(stored, ("k",), "at", digest="digest").select("k", "s").collect())) == sorted(map(tuple, whole.collect()))
    plan = newest_per_key(stored, ("k",), "at", digest="digest").select("k")._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan.split("Window")[0]
