"""Vectors, conversations, the registered queries and the pipeline."""
from __future__ import annotations

import hashlib
import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postings_lake.llm import chat, crosspolytope, queries
from postings_lake.llm.oracle_sql import ORACLES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
R = random.Random(8)


def neighbours(df, **kw):
    out = {}
    for r in crosspolytope.nearest(df, F.col("vec_id") % 10 == 0, **kw).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_neighbours_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 24))
    x = (centre[rng.integers(0, 12, 900)] + 0.5 * rng.normal(size=(900, 24))).astype(np.float32)
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).repartition(3)
    want = crosspolytope.brute_force(rows, every=10)
    for block in (8192, 30):
        got = neighbours(df, query_block=block)
        assert set(got) == set(want)
        hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want]
        assert sum(hits) / sum(map(len, want.values())) >= 0.9
    for q, found in got.items():
        for v, d in found:
            assert d == pytest.approx(float(np.linalg.norm(x[q].astype(float) - x[v].astype(float))), abs=1e-12)
        assert found == sorted(found, key=lambda p: (p[1], p[0]))


def test_all_probes_is_brute_force_with_ties_copies_and_bad_rows(spark):
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(0, 40)] + [(100 + i, [R.random(), R.random(), 1.0]) for i in range(20)]
    bad = [(50, None), (60, [0.0, 0.0, 0.0]), (70, [1.0, None, 2.0]), (80, [float("nan"), 1.0, 1.0]), (90, [float("inf"), 0.0, 1.0]),
           (None, [1.0, 2.0, 3.0]), (200, []), (300, [1.0, 2.0]), (0, [1.0, 0.0, 2.0]), (10, [None, 1.0, 1.0]), (20, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(4)
    got = neighbours(df, probes=0, k=5)
    want = crosspolytope.brute_force(rows + [(300, [1.0, 2.0])], every=10, k=5)
    assert {q: [v for v, _ in f] for q, f in got.items()} == {q: [v for v, _ in f] for q, f in want.items() if f}


def test_an_id_repeated_more_than_k_times_takes_one_place(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(60)]
    near = np.array(rows[10][1])
    copies = [(7, [float(v) for v in near + 1e-3 * rng.normal(size=8)]) for _ in range(30)]
    copies += [(i, rows[i][1]) for i in (11, 12, 13)]
    df = spark.createDataFrame(rows + copies, "vec_id long, embedding array<double>").coalesce(1)
    want = {}
    for q, found in crosspolytope.brute_force(rows + copies, every=10, k=200).items():
        least = {}
        for v, d in found:
            least.setdefault(v, d)
        want[q] = list(least)[:10]
    for probes in (0, 16):  # 16 probes of 8 dimensions are all buckets
        got = neighbours(df, probes=probes)
        assert {q: [v for v, _ in f] for q, f in got.items()} == want


def test_few_rows_return_all_candidates(spark):
    rows = [(i, [float(np.cos(i)), float(np.sin(i)), i / 7.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {q: len(f) for q, f in neighbours(df, tables=1, probes=1).items()} == {0: 5}
    assert neighbours(df.where("false")) == {}


def test_rotations_keep_lengths():
    x = np.random.default_rng(2).normal(size=(50, 24))
    for axes in crosspolytope.Rotations(24, 3)(x):
        assert axes.shape == (50, 64) and np.allclose((axes[:, :32] ** 2).sum(1), 1)


TURNS = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_round_trip_of_hostile_texts(spark):
    pieces = ["</s>", "<|", "|>", "~", "~0", "~1", "~2", "<", "|", "</s", "/s>", "a", "é", "🙂", "", "\n", "[INST]", "<|user|>", "\\"]
    rows = [(c, t, R.choice(["user", "assistant", "system", "a|b", "<|x|>", "~1", "", None]),
             R.choice([None, "".join(R.choice(pieces) for _ in range(R.randint(0, 8)))]), "clash")
            for c in range(60) for t in range(R.randint(1, 6))]
    rows += [(70, 0, "assistant", "twice", "c"), (70, 0, "assistant", "twice", "c"), (None, None, "user", "no id", "c")]
    rows.append((71, 0, "assistant", "long ~ </s> " * 20_000, "c"))
    out = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, TURNS))).collect()
    by = {}
    for c, t, r, x, _ in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert {r["conv_id"] for r in out} == set(by) and all(r["round_trip"] for r in out)
    for r in out:
        want = [(role, x) for _, role, x in sorted(by[r["conv_id"]])]
        assert [tuple(t) for t in r["turns"]] == want
        assert r["loss_text"] == "".join(x for role, x in want if role == "assistant")


def test_chat_leaves_harmless_texts_as_they_are(spark):
    rows = [(1, 0, "user", "if a < b | c ~ d then <tag>", "x"), (1, 1, "assistant", "</s>", "x")]
    out = chat.format_conversations(spark.createDataFrame(rows, TURNS)).first()
    assert out["formatted"] == "<|user|>if a < b | c ~ d then <tag></s><|assistant|>~1/s></s>"
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_native_operators_run_no_python(spark, tmp_path):
    docs = spark.createDataFrame([(1, "token = abcdefgh1234")], "doc_id long, text string")
    from postings_lake.llm import secrets

    plans = [secrets.scan(docs, [0] * 128 * 128), chat.read_back(chat.format_conversations(spark.createDataFrame([], TURNS)))]
    for df in plans:
        p = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in p for word in ("Python", "Pandas", "Arrow"))


# --- the registered queries --------------------------------------------------------------

@needs_data
def test_queries_match_their_sql(spark):
    from tools.check_oracles import compare

    results = list(compare(spark, SF, sorted(ORACLES)))
    assert results and not [r for r in results if not r[1]]


CONTRACT = {
    "op1_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op3_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op4_quality": ["doc_id", "held_out", "score", "predicted"],
    "op5_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op6_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted", "evidence"],
    "op9_simhash": ["doc_id", "fingerprint", "component_id"],
    "op10_maxent": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op11_hardneg": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op12_fillmiddle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op13_tokenfiles": ["doc_id", "start", "n_tokens", "ids_crc32"],
}


@pytest.fixture()
def tables(spark, tmp_path):
    """The tables with nulls everywhere, repeats and clashing columns; or empty."""
    def write(empty):
        path = str(tmp_path / ("empty" if empty else "odd"))
        texts = ["the cat sat on the mat\nand slept", "der hund und die katze", None, "", "token = abcdef123456", "scum idiot scum", "X!! Y!!"]
        docs = [(i, texts[i % len(texts)], [None, "en", "de"][i % 3], None, None) for i in range(70)] + [(None, "lost", "en", None, 3), (1, texts[1], "de", None, 1)]
        data = {
            "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
            "labels": ([(i, [0, 1, 1, None][i % 4], [1, 0, 0, None][i % 4]) for i in range(70)] + [(None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int"),
            "benchmark": ([(1, "the cat sat"), (2, None), (None, "")], "item_id long, text string"),
            "embeddings": ([(i, [float(i % 7), 1.0, None if i == 9 else 2.0], None) for i in range(30)] + [(None, None, None)], "vec_id long, embedding array<float>, label int"),
            "conversations": ([(1, 0, "user", None), (1, 1, "assistant", "hi"), (None, None, None, None)], "conv_id long, turn long, role string, text string"),
        }
        for name, (rows, schema) in data.items():
            df = spark.createDataFrame([] if empty else rows, schema)
            for clash in ("score", "n_tokens", "fp", "spans", "hit_words", "turns", "rank"):
                df = df.withColumn(clash, F.lit("clash"))
            df.coalesce(2).write.parquet(f"{path}/{name}.parquet")
        return path

    return write


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_odd_and_empty_tables(spark, tables, name):
    odd = queries.QUERIES[name](spark, tables(False))
    assert odd.columns == CONTRACT[name]
    expected = {"op5_neighbours": 10, "op7_chat": 3, "op11_hardneg": 0}.get(name, 72)
    assert len(odd.collect()) == expected
    assert queries.QUERIES[name](spark, tables(True)).count() == (1 if name == "op7_chat" else 0)


def test_pipeline_on_odd_and_empty_tables(spark, tables):
    import corpus_pipeline

    path = tables(False)
    docs = queries.table(spark, path, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns, name
    out = corpus_pipeline.run(spark, path).collect()
    assert all(r["exact"] for r in out)
    assert corpus_pipeline.run(spark, tables(True)).count() == 0


@needs_data
def test_pipeline_decisions(spark):
    """Each stage against a plain re-computation of its decision."""
    import corpus_pipeline
    from postings_lake.llm import decontaminate, simhash

    docs = queries.table(spark, SF, "documents")
    (_, good), (_, unique), (_, clean), (_, redact), (_, encode) = corpus_pipeline.STAGES
    kept = good(spark, docs, SF)
    scores = {r["doc_id"]: r["predicted"] for r in queries.op4_quality(spark, SF).collect()}
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert {d for d, _ in rows} == {d for d, p in scores.items() if p}
    one = [(r["doc_id"], r["text"]) for r in unique(spark, kept, SF).collect()]
    assert {d for d, _ in one} == {c for _, c in simhash.brute_force(rows).values()}
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    left = {d for d, (n, hit, _) in decontaminate.brute_force(one, items).items() if not (hit and 20 * hit >= n)}
    third = clean(spark, kept.join(spark.createDataFrame([(d,) for d, _ in one], "doc_id long"), "doc_id").select(*docs.columns), SF)
    assert {r["doc_id"] for r in third.collect()} == left
    texts, was = {r["doc_id"]: r["text"] for r in third.collect()}, dict(one)
    from tests.llm.test_text_operators import cut_plainly

    assert texts == {d: cut_plainly(was[d], [t for _, t in items], corpus_pipeline.SPAN) for d in left}
    after = redact(spark, third, SF)
    assert {r["doc_id"] for r in after.collect()} == left
    for r in after.collect():
        assert r["n_chars"] == len(r["text"]) or corpus_pipeline.MARK not in r["text"]
    assert all(r["exact"] and r["n_tokens"] >= 0 for r in encode(spark, after, SF).collect())


@needs_data
def test_neighbour_query_recall(spark):
    rows = [(r[0], list(r[1])) for r in queries.table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    want = crosspolytope.brute_force(rows)
    got = {}
    for r in queries.op5_neighbours(spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len(got[q] & {v for v, _ in w}) for q, w in want.items()) >= 0.9 * sum(map(len, want.values()))


@needs_data
def test_chat_query_holds_the_tricky_conversation(spark):
    row = queries.op7_chat(spark, SF).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert (row["n_turns"], row["loss_chars"]) == (2, len(text))
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    json.dumps(row.asDict())
