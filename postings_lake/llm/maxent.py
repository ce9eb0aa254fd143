"""Language-model scores from a hashed maximum-entropy model.

Tokens are the words between ASCII white space (A-Z lowered) and one end token a
text. The model has two levels. The prior has a softmax factored by classes,
P0(token | history) = P(class | history) * P(token | class). The class of a word is a
hash of its last two bytes; the end token has a class of its own.

P(class | history) is a maximum-entropy model: one weight row of ``CLASSES``
values for the hash of the previous token, of the two previous tokens (n-grams)
and of the second previous token alone (skip), plus a bias. It is
trained by distributed gradient updates: every task runs mini-batch AdaGrad over
all its training texts, and Spark averages the tasks' rows, weighted by how
often a task used them. P(token | class) has a bias for each token only, whose
best value is the smoothed relative count, so it comes from the corpus counts:
one slot more than the class has tokens stands for unknown ones.

Above it, every n-gram (two tokens of history and the token) of the training texts is
a feature with a weight of its own, so these tables grow with the corpus. With counts
c(history, token), c(history) and the n(history) different tokens that follow it, the
weight over the prior is log(1 + (c - D) / (D n P0)), D = ``DISCOUNT``: then
P = (c - D + D n P0) / c(history), which sums to 1 over all tokens, meets the
discounted counts, and is D n P0 / c(history) for tokens never seen there, P0 after a
history never seen. N-grams are 64-bit hashes (40 bits history, 24 token) and are
dealt by their history, with those that ask for them, over buckets of about
``BUCKET_BYTES`` of text: a bucket is sorted, counted and answered in one go.

Counts cover every training token. Those of the most frequent tokens (at most
``HEAD``) are broadcast; the rest of each text's tokens is looked up by a join
on their hashes. Tokens are known by 64-bit hashes.

Defined cases: null and empty texts hold the end token only; a null ``doc_id``
is never held out; repeated rows count and are scored each; no training rows
leave every count zero; kept columns named as the results are replaced by them, other
extra columns change nothing. The documents are read twice, in the same order, as
files are.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postings_lake.llm.common import Shared, map_texts, stored
from postings_lake.llm.textarrays import Words, blocks, mix64, spaced_words, strings

CLASSES = 16  # the last one is the end token's
ROWS = 4096  # of each feature template
TEMPLATES = 3
HEAD = 1 << 19
END = np.uint64(1)
BATCH = 8192
RATE = 0.4
DISCOUNT = 0.75  # taken from the count of each n-gram
BUCKET_BYTES = 8 << 20  # text bytes whose n-grams one bucket holds
BLOCK_DOCS = 1 << 16  # 16 bits tell a block's documents apart
LOW = np.uint64((1 << 24) - 1)  # the token's bits of an n-gram's key


class Tokens:
    """The token stream of a batch: hashes, classes and history features."""

    def __init__(self):
        self.table = spaced_words()
        self.words = Words(self.table)

    def __call__(self, column):
        """``(hash, class, doc)`` of every token."""
        data, at = strings(column)
        s, e, h = self.words.all(data, at)
        n_docs = len(at) - 1
        doc = np.searchsorted(at, s, "right") - 1
        place = np.arange(len(h)) + doc
        last = np.searchsorted(doc, np.arange(n_docs), "right") + np.arange(n_docs)
        n = len(h) + n_docs
        hashes, classes, docs = np.full(n, END), np.full(n, CLASSES - 1, np.int64), np.empty(n, np.int64)
        hashes[place] = h
        before = np.where(e - s > 1, self.table[data[np.maximum(e - 2, 0)]], np.uint64(0)) if len(e) else h
        tail = mix64(self.table[data[e - 1]] * np.uint64(3) + before) if len(e) else h
        classes[place] = (tail % np.uint64(CLASSES - 1)).astype(np.int64)
        docs[place], docs[last] = doc, np.arange(n_docs)
        start = np.concatenate([[0], last[:-1] + 1]) if n_docs else last
        self.start = start
        return hashes, classes, docs

    def back(self, hashes: np.ndarray) -> list[np.ndarray]:
        """The previous and the second previous token of each of the latest stream."""
        n = len(hashes)
        back = []
        for k in (1, 2):
            b = np.empty(n, np.uint64)
            b[k:] = hashes[:-k] if k < n else hashes[:0]
            for j in reversed(range(k)):  # before a text's first tokens; an empty text's second is the next one's first
                at = self.start + j
                b[at[at < n]] = 77 + k - j
            back.append(b)
        return back

    def ngrams(self, hashes: np.ndarray) -> np.ndarray:
        """Keys of the n-grams that end in each token of the latest stream."""
        back = self.back(hashes)
        return (mix64(back[0] * np.uint64(3) + mix64(back[1])) & ~LOW) | (hashes >> np.uint64(40))

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Weight rows (tokens, TEMPLATES) of the histories of the latest stream."""
        n, back = len(hashes), self.back(hashes)
        out = np.empty((n, TEMPLATES), np.int32)
        spread, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - ROWS.bit_length() + 1)
        for i, key in enumerate((back[0], back[0] * np.uint64(3) + back[1], back[1] + np.uint64(2))):
            out[:, i] = (key * spread) >> shift
            out[:, i] += i * ROWS
        return out


def log_classes(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Natural log-probabilities (tokens, CLASSES); the last weight row is the bias."""
    z = weights[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        z += weights[rows[:, k]]
    z += weights[-1]
    z -= z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


class Trainer:
    """Mini-batch AdaGrad on one task's texts."""

    def __init__(self, weights: np.ndarray | None = None):
        n = TEMPLATES * ROWS + 1
        self.weights = np.zeros((n, CLASSES), np.float32) if weights is None else weights.copy()
        self.squares, self.used = np.zeros(n, np.float32), np.zeros(n, np.int64)

    def update(self, rows: np.ndarray, classes: np.ndarray) -> None:
        for lo in range(0, len(rows), BATCH):
            r, y = rows[lo:lo + BATCH], classes[lo:lo + BATCH]
            g = np.exp(log_classes(self.weights, r))
            g[np.arange(len(y)), y] -= 1
            self._step(np.array([len(self.weights) - 1]), g.sum(0, keepdims=True), np.array([len(y)]))
            for k in range(TEMPLATES):
                order = np.argsort(r[:, k].astype(np.uint16), kind="stable")
                ids = r[order, k]
                last = np.append(np.flatnonzero(np.diff(ids)), len(ids) - 1)
                sums = np.cumsum(g[order], axis=0, dtype=np.float64)[last]
                sums[1:] -= sums[:-1].copy()
                self._step(ids[last], sums.astype(np.float32), np.diff(last, prepend=-1))

    def _step(self, ids: np.ndarray, grad: np.ndarray, n: np.ndarray) -> None:
        self.squares[ids] += (grad * grad).sum(1)
        self.used[ids] += n
        self.weights[ids] -= RATE * grad / np.sqrt(self.squares[ids] + 1e-3)[:, None]


def _train(batches):
    import pyarrow as pa

    tokens, trainer = Tokens(), Trainer()
    for batch in batches:
        for part in blocks(batch, 2 << 20):
            hashes, classes, _ = tokens(part.column("text"))
            trainer.update(tokens.rows(hashes), classes)
    ids = np.flatnonzero(trainer.used)
    if len(ids):
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(trainer.used[ids])] + [pa.array(trainer.weights[ids, c]) for c in range(CLASSES)],
            names=["id", "used"] + [f"w{c}" for c in range(CLASSES)])


def class_weights(training: DataFrame) -> np.ndarray:
    """Weights averaged over tasks by use; the driver receives ROWS * TEMPLATES + 1 rows."""
    schema = "id long, used long, " + ", ".join(f"w{c} float" for c in range(CLASSES))
    mixed = training.select("text").mapInArrow(_train, schema).groupBy("id").agg(
        *[(F.sum(F.col(f"w{c}") * F.col("used")) / F.sum("used")).alias(f"w{c}") for c in range(CLASSES)])
    got = mixed.toArrow()
    out = np.zeros((TEMPLATES * ROWS + 1, CLASSES), np.float32)
    for c in range(CLASSES):
        out[got.column("id").to_numpy(), c] = got.column(f"w{c}").to_numpy()
    return out


def _count(batches):
    import pyarrow as pa

    tokens = Tokens()
    for batch in batches:
        for part in blocks(batch):
            hashes, classes, _ = tokens(part.column("text"))
            h, first, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(classes[first].astype(np.int32)), pa.array(n)], names=["h", "cls", "n"])


def token_counts(training: DataFrame) -> DataFrame:
    """``(h, cls, c)``: every training token's hash, class and count."""
    return training.select("text").mapInArrow(_count, "h long, cls int, n long").groupBy("h", "cls").agg(F.sum("n").alias("c"))


class Lookup:
    """Counts of the tokens in a sorted hash array, found by their top bits."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """The count of each hash, -1 where the array lacks it."""
        if not len(self.keys):
            return np.full(len(h), -1, np.int64)
        bits = max(1, len(self.keys).bit_length())
        if not hasattr(self, "begin"):
            self.begin = np.searchsorted(self.keys >> np.uint64(64 - bits), np.arange(2**bits + 1, dtype=np.uint64))
        top = (h >> np.uint64(64 - bits)).astype(np.int64)
        at, end = self.begin[top], self.begin[top + 1]
        out = np.full(len(h), -1, np.int64)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            found = self.keys[at[open_]] == h[open_]
            out[open_[found]] = self.counts[at[open_[found]]]
            open_ = open_[~found]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return out


class Model:
    """What the prior needs of the corpus, all of bounded size, and the ``training``
    texts, whose n-grams stay with the tasks."""

    def __init__(self, weights: np.ndarray, head: Lookup, class_totals: dict[int, tuple[int, int]], training: DataFrame | None = None):
        self.weights, self.head, self.training = weights, head, training
        self.total = sum(n for n, _ in class_totals.values())
        self.distinct = sum(v for _, v in class_totals.values())
        self.log_base = np.log10(self.total + 0.5 * (self.distinct + 1))
        self.log_class = np.array([np.log10(n + 0.5 * (v + 1)) for n, v in (class_totals.get(c, (0, 0)) for c in range(CLASSES))])

    def __getstate__(self):
        return {**self.__dict__, "training": None}

    def log_prior(self, tokens: Tokens, h: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """log10 P0 of each token of the latest stream, but for log10(count + 0.5)."""
        rows, out = tokens.rows(h), -self.log_class[cls]
        for lo in range(0, len(h), BATCH):
            hi = min(lo + BATCH, len(h))
            out[lo:hi] += log_classes(self.weights, rows[lo:hi])[np.arange(hi - lo), cls[lo:hi]] / np.log(10)
        return out


def _counter(shared):
    import pyarrow as pa

    model, tokens = shared.value, Tokens()

    def run(batch):
        n = batch.num_rows
        h, _, doc = tokens(batch.column("text"))
        c = model.head(h)
        known = c >= 0
        return [pa.array(np.bincount(doc, minlength=n)), pa.array(np.bincount(doc[known], minlength=n)),
                pa.array(np.bincount(doc, np.where(known, np.log10(np.maximum(c, 0) + 0.5), 0.0), n))]

    return run


def to_planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second ones and so on: equal ones compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def short(values: np.ndarray) -> np.ndarray:
    """float32 values rounded to 24 bits, the last byte 0."""
    bits = values.astype("<f4").view("<u4")
    return ((bits + np.uint32(0x80)) & np.uint32(0xFFFFFF00)).view("<f4")


SENT = "bucket int, row0 long, docs int, learned binary, keys binary, doc binary, times binary, prior binary, known binary, rest binary"


def _sender(shared, buckets: int, fields):
    """Every n-gram of each block of texts, in the order of keys, cut by bucket: differences
    of keys, and of scored texts the prior, whether the head knows the token, and the
    hashes of those that it lacks, whose prior has no count yet."""

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        model, tokens, schema = shared.value, Tokens(), to_arrow_schema(fields)
        edges = np.arange(1, buckets, dtype=np.uint64) * np.uint64((2**64 - 1) // buckets)
        for batch in batches:
            for wide in blocks(batch, 4 << 20):
                for lo in range(0, wide.num_rows, BLOCK_DOCS):
                    part = wide.slice(lo, BLOCK_DOCS)
                    h, cls, doc = tokens(part.column("text"))
                    row_key = part.column("row_key")
                    scored = row_key.null_count == 0
                    row0 = row_key[0].as_py()
                    if scored and row_key[-1].as_py() - row0 != len(row_key) - 1:
                        raise ValueError("the documents' rows are not numbered one by one")
                    learned = np.packbits(part.column("learned").to_numpy(zero_copy_only=False).astype(bool)).tobytes()
                    key = tokens.ngrams(h)
                    order = np.argsort(key, kind="stable")
                    k, d = key[order], doc[order]
                    first = np.ones(len(k), bool)  # of equal n-grams of one text
                    first[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
                    begin = np.flatnonzero(first)
                    times = np.diff(np.append(begin, len(k))).astype("<u4")
                    k, d, one = k[begin], d[begin].astype("<u2"), order[begin]
                    if scored:
                        prior, c, h = model.log_prior(tokens, h, cls)[one], model.head(h[one]), h[one]
                        known = c >= 0
                        prior = short(np.where(known, prior + np.log10(np.maximum(c, 0) + 0.5), prior))
                    cut = np.concatenate([[0], np.searchsorted(k, edges), [len(k)]])
                    out = []
                    for i in np.flatnonzero(np.diff(cut)).tolist():
                        at = slice(cut[i], cut[i + 1])
                        out.append((i, row0, part.num_rows, learned, to_planes(np.diff(k[at], prepend=np.uint64(0))), d[at].tobytes(), to_planes(times[at]),
                                    *((to_planes(prior[at]), np.packbits(known[at]).tobytes(), h[at][~known[at]].tobytes()) if scored else (b"", b"", b""))))
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)

    return run


def one_by_one(batch):
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


ANSWERED = "row0 long, docs int, doc binary, part binary, row_key array<long>, h array<long>, times array<long>, seen array<float>, unseen array<float>"


def _answered(batches, fields):
    """What each block's documents get from a bucket: sums of log10 P, and for tokens
    whose count is joined later the parts of P (``unseen`` times count + 0.5)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(fields)

    def answer(rows):
        sizes = [len(r["keys"]) // 8 for r in rows]
        key = np.concatenate([np.cumsum(from_planes(r["keys"], "<u8"), dtype=np.uint64) for r in rows])
        doc = np.concatenate([np.frombuffer(r["doc"], "<u2") for r in rows])
        times = np.concatenate([from_planes(r["times"], "<u4") for r in rows])
        edge = np.cumsum([0, *sizes])
        learned = np.concatenate([np.unpackbits(np.frombuffer(r["learned"], np.uint8))[doc[a:b]] for r, a, b in zip(rows, edge, edge[1:])])
        order = np.argsort(key)
        ordered = key[order]
        first = np.ones(len(ordered), bool)
        first[1:] = ordered[1:] != ordered[:-1]
        ngram = np.flatnonzero(first)
        count = np.add.reduceat((times * learned)[order], ngram, dtype=np.int64)
        history = ordered[ngram] >> np.uint64(24)
        first = np.ones(len(history), bool)
        first[1:] = history[1:] != history[:-1]
        begin = np.flatnonzero(first)
        of = np.cumsum(first) - 1
        total = np.add.reduceat(count, begin)[of]
        follow = np.add.reduceat((count > 0).astype(np.int64), begin)[of]
        seen = np.maximum(count - DISCOUNT, 0) / np.maximum(total, 1)
        unseen = np.where(total > 0, DISCOUNT * follow / np.maximum(total, 1), 1.0)
        which = np.empty(len(key), np.int64)
        which[order] = np.repeat(np.arange(len(ngram)), np.diff(np.append(ngram, len(key))))
        for r, a, b in zip(rows, edge, edge[1:]):
            if r["row0"] is None:
                continue
            prior, d, n, w = from_planes(r["prior"], "<f4").astype(float), doc[a:b], times[a:b].astype(np.int64), which[a:b]
            rest = np.unpackbits(np.frombuffer(r["known"], np.uint8))[:b - a] == 0
            p = unseen[w] * 10.0**prior
            log = np.where(rest, 0.0, n * np.log10(np.where(rest, 1.0, seen[w] + p)))
            docs, sums = np.unique(d), np.bincount(d, log)
            yield (r["row0"], r["docs"], docs.tobytes(), sums[docs].astype("<f4").tobytes(), r["row0"] + d[rest].astype(np.int64),
                   np.frombuffer(r["rest"], "<i8"), n[rest], seen[w][rest].astype(np.float32), p[rest].astype(np.float32))

    def made(rows):
        out = list(answer(rows))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)

    held = []
    for batch in batches:
        for row in one_by_one(batch):
            if held and row["bucket"] != held[0]["bucket"]:
                yield from made(held)
                held = []
            held.append(row)
    if held:
        yield from made(held)


def _summed(batches):
    """``row_key, __part``: the sums of each block's documents over buckets."""
    import pyarrow as pa

    def made(row0, sums):
        return pa.RecordBatch.from_arrays([pa.array(row0 + np.arange(len(sums))), pa.array(sums)], names=["row_key", "__part"])

    row0, sums = None, None
    for batch in batches:
        for row in one_by_one(batch):
            if row["row0"] != row0:
                if sums is not None:
                    yield made(row0, sums)
                row0, sums = row["row0"], np.zeros(row["docs"])
            sums[np.frombuffer(row["doc"], "<u2")] += np.frombuffer(row["part"], "<f4")
    if sums is not None:
        yield made(row0, sums)


def fit(training: DataFrame, head: int = HEAD) -> tuple[Model, DataFrame]:
    """The model and the stored counts of all training tokens (``training``: text)."""
    counts = stored(token_counts(training), "token-counts")
    level = F.floor(8 * F.log2("c")).cast("int")  # a few hundred levels at most
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    lowest, held = 1 << 30, 0
    for lv in sorted(sizes, reverse=True):
        if held + sizes[lv] > head:
            break
        lowest, held = lv, held + sizes[lv]
    top = counts.filter(level >= lowest).select("h", "c").toArrow()
    lookup = Lookup(top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy())
    totals = {r["cls"]: (r["n"], r["v"]) for r in counts.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    return Model(class_weights(training), lookup, totals, training.select("text")), counts


def text_bytes(df: DataFrame) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length("text") + 8), F.lit(0)).alias("n")).first()["n"]


def score(documents: DataFrame, model: Model, counts: DataFrame, keep: list[str] | None = None, learned: Column | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities).

    ``learned`` marks the documents that are the texts given to ``fit``, each of them
    once; without it those texts are read again beside ``documents``.
    """
    keep = documents.columns if keep is None else keep
    spark = documents.sparkSession
    shared, rows = Shared(spark, model), documents.withColumn("row_key", F.monotonically_increasing_id())
    parts = stored(map_texts(
        rows, [c for c in keep if c != "row_key"] + ["row_key"],
        "n_tokens long, head_known long, head_log double", _counter, (shared,)), "token-parts")
    asking = rows.select("text", "row_key", (F.lit(False) if learned is None else learned).alias("learned"))
    if learned is None and model.training is not None:
        asking = asking.unionByName(model.training.select("text", F.lit(None).cast("long").alias("row_key"), F.lit(True).alias("learned")))
    buckets = max(1, -(-text_bytes(asking) // BUCKET_BYTES))
    to_send, to_answer = StructType.fromDDL(SENT), StructType.fromDDL(ANSWERED)
    sent = asking.mapInArrow(_sender(shared, buckets, to_send), to_send).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    answers = stored(sent.mapInArrow(lambda b: _answered(b, to_answer), to_answer), "token-answers")
    summed = answers.select("row0", "docs", "doc", "part").repartition(buckets, "row0").sortWithinPartitions("row0").mapInArrow(_summed, "row_key long, __part double")
    rest = answers.select(F.explode(F.arrays_zip("row_key", "h", "times", "seen", "unseen")).alias("t")).select("t.*")
    c = F.coalesce("c", F.lit(0)) + 0.5
    found = rest.join(counts.select("h", "c"), "h", "left").groupBy("row_key").agg(
        F.sum(F.col("times") * F.log10(c)).alias("rest_log"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("times") * F.log10(F.col("seen") + F.col("unseen") * c)).alias("rest_part"))
    token_log = F.col("head_log") + F.coalesce("rest_log", F.lit(0.0))
    made = {
        "n_known": F.col("head_known") + F.coalesce("rest_known", F.lit(0)),
        "train_tokens": F.lit(model.total).cast("long"),
        "base_score": token_log - F.col("n_tokens") * F.lit(float(model.log_base)),
        "score": F.col("__part") + F.coalesce("rest_part", F.lit(0.0)),
    }
    outputs = {"n_tokens", *made}
    return parts.join(summed, "row_key").join(found, "row_key", "left").select(
        *[c for c in keep if c.lower() not in outputs], "n_tokens", *[v.alias(k) for k, v in made.items()])


def held_out(documents: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Documents with a ``held_out`` column, and those to learn from."""
    marked = documents.withColumn("held_out", rule)
    return marked, marked.filter(~F.col("held_out"))


def brute_force(rows: list[tuple], is_held_out) -> dict:
    """``doc_id -> (n_tokens, n_known, train_tokens, base score)`` by plain counting (tests)."""
    import math
    import re
    from collections import Counter

    lower = {i: i + 32 for i in range(65, 91)}
    split = {d: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), None] for d, t in rows}
    c = Counter(w for d, ws in split.items() if not is_held_out(d) for w in ws)
    n, v = sum(c.values()), len(c)
    return {d: (len(ws), sum(c[w] > 0 for w in ws), n,
                sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for d, ws in split.items()}
