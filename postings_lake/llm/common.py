"""Spark helpers shared by the operators of this subpackage."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings_lake.llm.textarrays import blocks


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` if the session names it, else the context's
    checkpoint folder. Where neither exists a local session (tests) gets a temporary
    one; on a cluster that is an error, as its machines share no temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="pl-llm-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(column: str, modulus: int) -> Column:
    """``crc32(column as text) mod modulus``; -1 where the column is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(-1))


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row; without it, a lambda that
    mentions an outer expression computes that anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def balanced_sample(rows: DataFrame, by: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows ``(doc_id, by)`` of each class, spread evenly.

    Ids are dealt by hash into ``per_class`` cells for each class and every
    cell keeps the id with the smallest hash: one aggregate that combines
    map-side, whatever the class sizes, and the same choice on every run.
    """
    h = F.xxhash64(F.col("doc_id").cast("string"))
    return (
        rows.filter(F.col("doc_id").isNotNull() & F.col(by).isNotNull())
        .groupBy(by, F.pmod(h, F.lit(per_class)).alias("cell"))
        .agg(F.min_by("doc_id", F.struct(F.xxhash64(h), F.col("doc_id"))).alias("doc_id"))
        .select("doc_id", by)
    )


def labelled_texts(documents: DataFrame, labels: DataFrame, by: str, per_class: int,
                   excluded: Column, max_bytes: int = 1 << 17) -> list[tuple[str, object, int]]:
    """``(text, class, smallest doc_id)`` of a bounded labelled sample, distinct
    texts in order.

    ``excluded`` (over ``doc_id``) takes rows out of learning, and so are texts of more
    than ``max_bytes``. The driver holds at most ``per_class`` texts of that size a
    class; the sample's ids are joined to ``documents`` in one scan.
    """
    chosen = balanced_sample(labels.filter(~excluded), by, per_class)
    rows = (
        documents.select("doc_id", "text").filter(F.octet_length("text") <= max_bytes)
        .join(F.broadcast(chosen), "doc_id")  # at most per_class ids a class
        .groupBy("text", by).agg(F.min("doc_id").alias("doc_id")).collect()
    )
    return sorted((r["text"], r[by], r["doc_id"]) for r in rows)


def platt(x, y, weight) -> tuple[float, float]:
    """``(slope, shift)`` of the weighted logistic fit of ``y`` on one value."""
    import numpy as np

    design, w = np.stack([x, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (weight * (y - p)) - 1e-3 * w
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def class_weight(labels: DataFrame, by: str, excluded: Column, y):
    """Weights that give a balanced sample the classes' shares of all labels."""
    import numpy as np

    n = {r[by]: r["n"] for r in labels.filter(~excluded).filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n")).collect()}
    y = np.asarray(y)
    have = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    w = np.array([n.get(int(c), 0) / have[int(c)] for c in y], float)
    return w * len(w) / max(w.sum(), 1e-9)


def map_texts(df: DataFrame, keep: list[str], fields: str, make, args: tuple = ()) -> DataFrame:
    """``keep`` columns of ``df`` plus new ``fields`` computed from whole texts.

    ``make(*args)`` runs once a task and returns ``batch -> list of Arrow
    arrays``, one for each of ``fields`` (DDL). ``df`` must hold ``text``; each
    batch holds about 8 MB of it. A kept column whose name is that of a new
    field is replaced by the field.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(fields)
    taken = {f.lower() for f in new.fieldNames()}
    kept = [c for c in dict.fromkeys(keep) if c.lower() not in taken]
    schema = StructType([df.schema[c] for c in kept] + new.fields)
    needed = kept + [c for c in ("text", *getattr(make, "reads", ())) if c not in kept]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        fn, types = make(*args), [f.type for f in to_arrow_schema(new)]
        for batch in batches:
            for part in blocks(batch):
                made = [a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a, t, from_pandas=False)
                        for a, t in zip(fn(part), types)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + made, names=kept + new.fieldNames())

    return df.select(*needed).mapInArrow(run, schema)


def aside(df: DataFrame):
    """``df`` with its columns (but ``text``) under names no operator uses, and
    the function that restores them, dropping all others."""
    names = [(c, c if c == "text" else f"__{c}") for c in df.columns]
    packed = df.select(*[F.col(c).alias(n) for c, n in names])
    return packed, lambda out: out.select(*[F.col(n).alias(c) for c, n in names])


class Shared:
    """A broadcast model. It travels as bytes with its classes, so workers need
    no copy of this package; callers bound the model's size."""

    def __init__(self, spark: SparkSession, model):
        from pyspark import cloudpickle

        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(model))

    @property
    def value(self):
        import pickle

        return pickle.loads(self.packed.value)
