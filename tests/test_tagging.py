"""Taxonomy tagging by n-gram joins: the same names as one pattern an entry gives."""
from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from postings_lake.functions import lexicon
from postings_lake.operators import tagging

R = random.Random(17)


def joined(spark, texts, taxonomy):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    return {r["id"]: list(r["skills"]) for r in tagging.with_tags(df, ("id",), F.col("text"), taxonomy).collect()}


def by_pattern(texts, taxonomy):
    patterns = {n: re.compile(r"(?<!\w)(?:" + "|".join(re.escape(s) for a in al for s in tagging.spellings(a)) + r")(?!\w)", re.IGNORECASE)
                for n, al in taxonomy.items()}
    return {i: sorted(n for n, p in patterns.items() if p.search(t or "")) for i, t in enumerate(texts)}


def test_default_taxonomy_equals_its_expressions(spark):
    parts = [a.replace("?", "") for al in lexicon.SKILL_TAXONOMY.values() for a in al] + [
        "NoSQL", "T-SQL", "javascript", "_aws", "aws_x", "éaws", "K8S", "K8s", "ſql", "MONGOİ", "hıve", "delta  lake", "delta table", "ci/ cd",
        ",", "(", " ", "\n", "-", "²", "́"]
    texts = ["".join(R.choice([*parts, " ", " ", "/"]) for _ in range(R.randint(0, 9))) for _ in range(600)]
    texts += [" ".join(R.choices(parts, k=12)).swapcase() for _ in range(100)] + [None, "", "sql", " sql ", "ci/cd", "x" * 5000 + " python"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = {r["id"]: list(r["s"]) for r in df.select("id", lexicon.skills("text").alias("s")).collect()}
    assert joined(spark, texts, lexicon.SKILL_TAXONOMY) == want
    assert len({tuple(v) for v in want.values()}) > 50


def test_aliases_of_every_kind_equal_patterns(spark):
    taxonomy = {"C++": ("c++", "cpp"), ".NET": (".net", "dot net"), "C#": ("c#",), "R&D": ("r&d",), "São Paulo": ("são paulo", "sp"),
                "Straße": ("straße",), "Ελλάδα": ("ελλάς", "ελλάδα"), "漢字": ("漢字",), "_x": ("_x_",), "--": ("--",), "Emoji": ("\U0001f600", "a\U0001f600"),
                "Deseret": ("\U00010428\U00010429",), "Both": ("colou?rs?",), "Empty": ("",)}
    del taxonomy["Empty"]
    parts = [s for al in taxonomy.values() for a in al for s in tagging.spellings(a)] + ["asp", "x", " ", ".", "++", "#", "Σ", "ς", "\U00010400\U00010401", "a"]
    texts = ["".join(R.choice([*parts, " "]) for _ in range(R.randint(1, 8))) for _ in range(1500)]
    texts += [t.upper() for t in texts[:300] if "ß" not in t]
    got, want = joined(spark, texts, taxonomy), by_pattern(texts, taxonomy)
    assert [(texts[i], got[i], want[i]) for i in want if got[i] != want[i]] == []


def test_ten_thousand_aliases(spark):
    letters = "abcdefghij"
    words = ["".join(R.choices(letters, k=R.randint(2, 5))) for _ in range(4000)]
    aliases = list(dict.fromkeys(" ".join(R.choices(words, k=R.choice([1, 1, 2, 3]))) + R.choice(["", "", "+", "/x"]) for _ in range(11_000)))[:10_000]
    taxonomy = {f"name{i % 3000:04d}": () for i in range(3000)}
    for i, a in enumerate(aliases):
        taxonomy[f"name{i % 3000:04d}"] += (a,)
    texts = [" ".join(R.choice([R.choice(words), R.choice(aliases), "zz"]) for _ in range(30)).title() for _ in range(150)]
    name_of = {}
    for n, al in taxonomy.items():
        for a in al:
            name_of.setdefault(a, set()).add(n)
    want = {}
    for i, t in enumerate(texts):
        low = t.lower()
        starts = [k for k in range(len(low)) if k == 0 or not (low[k - 1].isalnum() and low[k].isalnum())]
        found = set()
        for k in starts:
            if k and low[k - 1].isalnum():
                continue
            for e in range(k + 1, min(len(low), k + 30) + 1):
                if (e == len(low) or not low[e].isalnum()) and low[k:e] in name_of:
                    found |= name_of[low[k:e]]
        want[i] = sorted(found)
    assert joined(spark, texts, taxonomy) == want and sum(map(len, want.values())) > 1500


def plan_size(spark, n):
    df = spark.range(3).select(F.col("id"), F.lit("some text").alias("text"))
    taxonomy = {f"n{i}": (f"alias{i}", f"two words{i}") for i in range(n)}
    tagged = tagging.with_tags(df, ("id",), F.col("text"), taxonomy)
    return len(tagged._jdf.queryExecution().analyzed().toString())


def test_the_plan_does_not_grow_with_the_taxonomy(spark):
    assert abs(plan_size(spark, 2000) - plan_size(spark, 20)) < 200


def test_the_planner_decides_how_aliases_are_joined(spark):
    texts, taxonomy = ["python and sql", "none", None], {"Python": ("python",), "SQL": ("sql",)}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            tagged = tagging.with_tags(df, ("id",), F.col("text"), taxonomy)
            assert "ResolvedHint" not in tagged._jdf.queryExecution().analyzed().toString()
            assert {r["id"]: list(r["skills"]) for r in tagged.collect()} == {0: ["Python", "SQL"], 1: [], 2: []}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_patterns_are_refused_and_no_aliases_tag_nothing(spark):
    for bad in ("a.*b?", "?x", "a??"):
        with pytest.raises(ValueError):
            tagging.spellings(bad)
    assert sorted(tagging.spellings("colou?rs?")) == ["color", "colors", "colour", "colours"]
    assert joined(spark, ["x"], {}) == {0: []}
