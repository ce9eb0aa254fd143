"""Toxicity by the nearest labelled texts under exact TF-IDF cosine.

Terms are words (A-Z lowered) and, for longer words, their first 4, 5 and 6
bytes, so that compounds of a stem meet. The vocabulary is every term of the
labelled sample. A text is the vector of (1 + log tf) * idf * (1 + chi-square) over
these terms: idf is counted over all documents, and the chi-square of a term and the
label in the sample lets terms that depend on the label weigh more and drops none.
(Terms that no labelled text holds would divide all cosines of a text alike.)

The labelled vectors form an inverted index in blocks of ``BLOCK`` texts. Terms
in fewer than one of ``RARE`` texts are lists of postings, which a query adds up;
the others are columns with the largest weight of each term in each block. A query
bounds each block's best cosine from both, visits blocks from the highest bound down
with exact cosines, and stops when no bound can beat its ``NEIGHBOURS``-th best. Votes of the
neighbours, weighted by closeness, become a probability by a logistic fit on the
sample's own leave-one-out votes. The nearest texts are returned as evidence.

Texts that share no term with the vocabulary have no neighbours; their score is
the (smoothed) share of toxic texts among such labelled texts.

Defined cases: null and empty texts have no terms; equal cosines rank by the
labelled texts' order in the index; texts are read whole; repeated rows are scored each; with
no labelled rows of both classes every score is the share of toxic labels (0
without labels); kept columns named as the results are replaced by them, other extra
columns change nothing.
"""
from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings_lake.llm.common import Shared, class_weight, labelled_texts, map_texts, platt
from postings_lake.llm.textarrays import Words, alnum_words, blocks, strings

PREFIXES = (4, 5, 6)
RARE = 16
BLOCK, NEIGHBOURS, EVIDENCE = 64, 15, 3


class Terms:
    """Distinct terms of each text of a batch with their counts."""

    def __init__(self):
        self.words = Words(alnum_words(), PREFIXES)

    def __call__(self, column, vocabulary: np.ndarray | None = None):
        """``(text, term, tf)``, sorted; only terms in ``vocabulary`` if given,
        then as positions in it."""
        data, at = strings(column)
        docs, terms = [], []
        for s, _, *hashes in self.words(data, at):
            doc = np.searchsorted(at, s, "right") - 1
            for h in hashes:
                if vocabulary is None:
                    keep = np.flatnonzero(h)
                    terms.append(h[keep])
                elif len(vocabulary):
                    place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                    keep = np.flatnonzero(vocabulary[place] == h)
                    terms.append(place[keep].astype(np.uint64))
                else:
                    continue
                docs.append(doc[keep])
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        docs, terms = np.concatenate(docs), np.concatenate(terms)
        if vocabulary is not None:  # both are small numbers: one sort of their pairs
            pairs = np.sort(docs * len(vocabulary) + terms.astype(np.int64))
            begin = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else pairs
            docs, terms = np.divmod(pairs[begin], max(1, len(vocabulary)))
            return docs, terms.astype(np.uint64), np.diff(np.append(begin, len(pairs)))
        order = np.lexsort((terms, docs))
        docs, terms = docs[order], terms[order]
        first = np.ones(len(docs), bool)
        first[1:] = (docs[1:] != docs[:-1]) | (terms[1:] != terms[:-1])
        begin = np.flatnonzero(first)
        return docs[begin], terms[begin], np.diff(np.append(begin, len(docs)))


def chi_square(present: np.ndarray, positive: np.ndarray, n: int, n_positive: int) -> np.ndarray:
    """Of terms in ``present`` texts, ``positive`` of them labelled 1."""
    a, b = positive.astype(float), (present - positive).astype(float)
    c, d = n_positive - a, n - n_positive - b
    return n * (a * d - b * c) ** 2 / np.maximum(present * (n - present) * float(n_positive) * (n - n_positive), 1e-9)


def alike(x: np.ndarray) -> np.ndarray:
    """An order of the rows in which those of a block are alike: halves by the main
    direction of their spread, again and again. Blocks of like texts have low bounds."""
    if len(x) <= BLOCK:
        return np.arange(len(x))
    x = x - x.mean(0)
    v = x[np.argmax((x**2).sum(1))]
    for _ in range(8):
        v = x.T @ (x @ v)
        v = v / max(float(np.linalg.norm(v)), 1e-30)
    order = np.argsort(x @ v, kind="stable")
    half = -(-len(x) // BLOCK) // 2 * BLOCK
    return np.concatenate([part[alike(x[part])] for part in (order[:half], order[half:])])


class ToxicityModel:
    """The block-max index over the labelled sample and the calibration."""

    def __init__(self, base: float):
        self.base, self.vocabulary = base, None

    def fit(self, found, y: np.ndarray, ids: np.ndarray, weight: np.ndarray, idf: np.ndarray) -> ToxicityModel:
        """``found`` are the sample's ``Terms``; ``idf`` is that of their distinct terms."""
        doc, term, tf = found
        self.vocabulary, term, present = np.unique(term, return_inverse=True, return_counts=True)
        n, v = len(y), len(self.vocabulary)
        self.factor = idf * (1 + chi_square(present, np.bincount(term, y[doc], v), n, int(y.sum())))
        value = (1 + np.log(tf)) * self.factor[term]
        norm = np.sqrt(np.bincount(doc, value**2, n))
        unit = (value / norm[doc]).astype(np.float32)
        padded = -(-n // BLOCK) * BLOCK
        common = present * RARE >= n
        self.place = np.where(common, np.cumsum(common) - 1, -1)  # a common term's column
        at = common[term]
        x = np.zeros((n, int(common.sum())), np.float32)
        x[doc[at], self.place[term[at]]] = unit[at]
        order = alike(x)
        y, ids, weight, norm = y[order], ids[order], weight[order], norm[order]
        doc = np.argsort(order)[doc]
        order = np.argsort(doc, kind="stable")
        doc, term, value, unit = doc[order], term[order], value[order], unit[order]
        self.y, self.ids = y.astype(float), ids
        self.dense = np.zeros((padded, int(common.sum())), np.float32, order="F")  # a term's column in one place
        at = common[term]
        self.dense[doc[at], self.place[term[at]]] = unit[at]
        self.peak = self.dense.T.reshape(-1, padded // BLOCK, BLOCK).max(2)  # term by block
        order = np.flatnonzero(~at)[np.argsort(term[~at], kind="stable")]
        self.row, self.unit = doc[order], unit[order]  # postings of the others, by term
        self.size = np.where(common, 0, present)
        self.begin = np.cumsum(self.size) - self.size
        self.blank = np.append(norm == 0, np.ones(padded - n, bool))
        votes = np.full(n, np.nan)
        for i, (t, q) in self._queries(doc, term, value, norm):
            votes[i] = self.vote(*self.neighbours(t, q, skip=i))
        linked = ~np.isnan(votes)
        if 0 < y[linked].sum() < linked.sum():
            self.slope, self.shift = platt(votes[linked], y[linked], weight[linked])
            if self.slope <= 0:  # too few labels to calibrate by: take the vote as it is
                self.slope, self.shift = 6.0, -3.0
        else:
            share = self._share(weight, y, linked)
            self.slope, self.shift = 0.0, float(np.log(share / (1 - share)))
        self.alone = self._share(weight, y, ~linked)
        return self

    def _share(self, weight: np.ndarray, y: np.ndarray, rows: np.ndarray) -> float:
        """Smoothed share of toxic texts among some labelled rows."""
        return float(np.clip(((weight * y)[rows].sum() + self.base) / (weight[rows].sum() + 1), 1e-6, 1 - 1e-6))

    @staticmethod
    def _queries(doc, term, value, norm):
        begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else doc
        for lo, hi in zip(begin, np.append(begin[1:], len(doc))):
            yield int(doc[lo]), (term[lo:hi].astype(np.int64), (value[lo:hi] / norm[doc[lo]]).astype(np.float32))

    def neighbours(self, t: np.ndarray, q: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Labelled rows nearest to the query over all terms and their cosines, exact."""
        place, size = self.place[t], self.size[t]
        at = np.repeat(self.begin[t] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        rest = np.bincount(self.row[at], self.unit[at] * np.repeat(q, size), len(self.dense)).astype(np.float32)
        return self.nearest(place[place >= 0], q[place >= 0], skip, rest)

    def nearest(self, t: np.ndarray, q: np.ndarray, skip: int = -1, rest: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Labelled rows nearest to the query by the common terms (their columns)
        and what the ``rest`` of the terms adds to each row's cosine."""
        rest = np.zeros(len(self.dense), np.float32) if rest is None else rest
        bound = q @ self.peak[t] + rest.reshape(-1, BLOCK).max(1)
        bound *= 1 + 1e-5  # rounding of either sum
        grid = self.dense.T.reshape(self.dense.shape[1], -1, BLOCK)
        order = np.argsort(-bound, kind="stable")
        rows, scores, least, lo, step = [], [], 0.0, 0, 4
        while lo < len(order) and bound[order[lo]] > least:
            some = order[lo:lo + step]  # the next few blocks by bound
            some = some[bound[some] > least]
            at = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            cosine = q @ grid[t[:, None], some].reshape(len(t), len(at)) + rest[at]
            keep = (cosine > least) & (at != skip) & ~self.blank[at]
            rows.append(at[keep])
            scores.append(cosine[keep])
            lo, step = lo + step, 2 * step
            if sum(map(len, rows)) >= NEIGHBOURS:
                r, s = np.concatenate(rows), np.concatenate(scores)
                top = np.lexsort((r, -s))[:NEIGHBOURS]
                rows, scores = [r[top]], [s[top]]
                least = float(s[top[-1]]) * (1 - 1e-6)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        r, s = np.concatenate(rows), np.concatenate(scores)
        top = np.lexsort((r, -s))[:NEIGHBOURS]
        return r[top], s[top]

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic neighbours, weighted by closeness; nan without any."""
        w = 1 / (1.05 - np.minimum(cosines, 1))
        return float((w * self.y[rows]).sum() / w.sum()) if len(rows) else float("nan")

    def score(self, terms: Terms, column, known: dict):
        """Scores and evidence (ids of the nearest labelled texts) of a batch."""
        if self.vocabulary is None:
            return np.full(len(column), self.base), [[]] * len(column)
        out, evidence = np.full(len(column), self.alone), [[] for _ in range(len(column))]
        doc, term, tf = terms(column, self.vocabulary)
        value = (1 + np.log(tf)) * self.factor[term.astype(np.int64)]
        norm = np.sqrt(np.bincount(doc, value**2, len(column)))
        for i, (t, q) in self._queries(doc, term, value, norm):
            key = hashlib.blake2b(t.tobytes() + q.tobytes(), digest_size=16).digest()
            if key not in known:
                if len(known) > 50_000:
                    known.clear()
                rows, cosines = self.neighbours(t, q)
                v = self.vote(rows, cosines)
                p = self.alone if np.isnan(v) else 1 / (1 + np.exp(-np.clip(self.slope * v + self.shift, -500, 500)))
                known[key] = (p, self.ids[rows[:EVIDENCE]].tolist())
            out[i], evidence[i] = known[key]
        return out, evidence


def inverse_frequency(documents: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """The idf of the terms in ``vocabulary``, over all documents. Tasks count for
    themselves; one number a term reaches the driver."""
    shared = Shared(documents.sparkSession, vocabulary)

    def run(batches):
        import pyarrow as pa

        known, terms, n = shared.value, Terms(), 0
        counts = np.zeros(len(known), np.int64)
        for batch in batches:
            for part in blocks(batch, 2 << 20):
                counts += np.bincount(terms(part.column("text"), known)[1].astype(np.int64), minlength=len(known))
                n += part.num_rows
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(counts[used], n))], names=["term", "n"])

    texts = documents.select("text").filter(F.col("text").isNotNull())
    sums = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = sums.column("term").to_numpy(), sums.column("n").to_numpy()
    count = np.zeros(len(vocabulary), np.int64)
    count[term[term >= 0]] = n[term >= 0]
    return np.log(1 + n[term < 0].sum() / np.maximum(1, count))


def fit(documents: DataFrame, labels: DataFrame, excluded: Column, label: str = "toxic", per_class: int = 1536) -> ToxicityModel:
    """Learns from at most ``per_class`` labelled texts of each class."""
    import pyarrow as pa

    sample = labelled_texts(documents, labels.select("doc_id", label), label, per_class, excluded)
    y = np.array([int(c) for _, c, _ in sample])
    weight = class_weight(labels, label, excluded, y)
    base = float((weight * y).sum() / weight.sum()) if len(y) else 0.0
    model = ToxicityModel(base)
    if len(set(y)) < 2:
        return model
    found = Terms()(pa.array([t for t, _, _ in sample]))
    idf = inverse_frequency(documents, np.unique(found[1]))
    return model.fit(found, y, np.array([i for _, _, i in sample]), weight, idf)


def _scorer(shared):
    model, terms, known = shared.value, Terms(), {}

    def run(batch):
        scores, evidence = [], []
        for part in blocks(batch, 2 << 20):
            s, e = model.score(terms, part.column("text"), known)
            scores += s.tolist()
            evidence += e
        return [scores, evidence]

    return run


def score(documents: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``score`` (calibrated probability of
    label 1) and ``evidence`` (``doc_id`` of the nearest labelled texts)."""
    return map_texts(documents, documents.columns if keep is None else keep, "score double, evidence array<long>",
                     _scorer, (Shared(documents.sparkSession, model),))
