"""Text quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its potential is linear in features of the line and
of the lines before and after it; a 2 x 2 transition matrix ties neighbours.
Training takes the label of a document for each of its lines and climbs the
exact conditional likelihood (forward-backward gradients); long documents count
in segments there. The quality of a document is the mean of its lines' marginal
probabilities of being good, weighted by their lengths, put through a logistic
calibration.

Defined cases: a text without any line (null, empty, only line breaks) is one
empty line; very long lines and texts are read whole; repeated rows are scored
each; with no labelled rows of both classes every score is the share of good
labels (0.5 without labels); a kept column named as the result is replaced by it,
other extra columns change nothing.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from postings_lake.llm.common import Shared, class_weight, labelled_texts, map_texts, platt
from postings_lake.llm.textarrays import Words, alnum_words, blocks, mix64, strings

SEGMENT = 24  # lines of a training sequence
ROUNDS = 200


def byte_classes() -> np.ndarray:
    """0 lower letter or beyond ASCII, 1 upper, 2 digit, 3 space, 4 sentence mark,
    5 exclamation or question mark, 6 quotes, hyphen and brackets, 7 other."""
    c = np.full(256, 7, np.uint8)
    c[97:123] = 0
    c[128:] = 0
    c[65:91] = 1
    c[48:58] = 2
    c[[32, 9, 11, 12, 13]] = 3
    c[list(b".,;:")] = 4
    c[list(b"!?")] = 5
    c[list(b"'\"-()")] = 6
    return c


class Lines:
    """Lines of a batch of texts and their features."""

    def __init__(self):
        self.words, self.classes = Words(alnum_words()), byte_classes()

    def __call__(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(features, lengths, lines of each text)``, neighbours included."""
        data, at = strings(column)
        body = data[at[0]:at[-1]]
        at = at - at[0]
        n_docs = len(at) - 1
        breaks = np.flatnonzero(body == 10)
        starts = np.union1d(at[:-1], breaks + 1)
        starts = starts[starts < len(body)]
        ends = np.append(starts[1:], len(body))
        ends = ends - (body[ends - 1] == 10) if len(ends) else ends
        doc = np.searchsorted(at, starts, "right") - 1
        full = ends > starts
        bare = np.setdiff1d(np.arange(n_docs), doc[full])  # texts without any line
        starts, ends = np.append(starts[full], at[bare]), np.append(ends[full], at[bare])
        doc = np.append(doc[full], bare)
        order = np.argsort(doc, kind="stable")
        starts, ends, doc = starts[order], ends[order], doc[order]
        own = self._features(body, starts, ends, doc)
        n = len(own)
        first, last = np.ones(n, bool), np.ones(n, bool)
        first[1:] = doc[1:] != doc[:-1]
        last[:-1] = first[1:]
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        before[first], after[last] = 0, 0
        x = np.concatenate([own, before, after, first[:, None], last[:, None], np.ones((n, 1))], 1, dtype=np.float32)
        return x, (ends - starts).astype(np.float64), np.bincount(doc, minlength=n_docs)

    def _features(self, body, starts, ends, doc) -> np.ndarray:
        n = len(starts)
        kinds, size = self.classes[body], np.maximum(ends - starts, 1)
        share = np.empty((n, 8), np.float32)
        for k in range(8):
            count = np.zeros(len(body) + 1, np.int32)
            np.cumsum(kinds == k, out=count[1:], dtype=np.int32)
            share[:, k] = (count[ends] - count[starts]) / size
        s, e, h = self.words.all(body, np.array([0, len(body)]))
        line = np.searchsorted(starts, s, "right") - 1 if n else s
        words = np.bincount(line, minlength=n)[:n]
        again = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
        repeats = np.bincount(line[1:][again], minlength=n)[:n] / np.maximum(words, 1)
        letters = np.bincount(line, (e - s).astype(float), n)[:n] / np.maximum(words, 1)
        place = np.arange(len(h)) - np.searchsorted(line, line)
        code = np.zeros(n, np.uint64)
        np.add.at(code, line, mix64(h + place.astype(np.uint64)))
        seen = np.lexsort((np.arange(n), code, doc))
        same = np.zeros(n, np.float32)
        same[seen[1:]] = (doc[seen[1:]] == doc[seen[:-1]]) & (code[seen[1:]] == code[seen[:-1]]) & (words[seen[1:]] > 0)
        end = kinds[np.maximum(ends - 1, 0)] == 4 if len(body) else np.zeros(n, bool)
        return np.column_stack([share, np.log1p(ends - starts), np.log1p(words), repeats, np.minimum(letters, 40) / 10,
                                same, (words <= 2), end, share[:, 7] > 0.02, share[:, 1] > 0.3]).astype(np.float32)


def chain(theta: np.ndarray, sizes: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log-odds (good over bad) of all lines.

    ``theta``: potentials of consecutive lines, ``sizes`` lines a sequence, ``t``
    log transition weights, [from][to] with 0 bad and 1 good. All sequences
    advance together, the longest ones to the end.
    """
    fore, back = np.empty_like(theta), np.zeros_like(theta)
    begin = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = begin[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    fore[begin] = theta[begin]
    for step in range(1, len(active)):
        i = begin[:active[step]] + step
        a = fore[i - 1]
        fore[i] = theta[i] + np.logaddexp(a + t[1, 1], t[0, 1]) - np.logaddexp(a + t[1, 0], t[0, 0])
    for step in range(len(active) - 2, -1, -1):
        i = begin[:active[step + 1]] + step
        b = back[i + 1] + theta[i + 1]
        back[i] = np.logaddexp(b + t[1, 1], t[1, 0]) - np.logaddexp(b + t[0, 1], t[0, 0])
    return fore, back


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class QualityModel:
    """The fitted field, feature scales and calibration."""

    def __init__(self, base: float):
        self.base, self.weights = base, None

    def fit(self, column, y: np.ndarray, weight: np.ndarray) -> QualityModel:
        x, lengths, sizes = Lines()(column)
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        self.mean[-1], self.scale[-1] = 0, 1
        z = ((x - self.mean) / self.scale).astype(np.float64)
        pieces = np.concatenate([np.append(np.full((n - 1) // SEGMENT, SEGMENT), (n - 1) % SEGMENT + 1) for n in sizes])
        target = np.repeat(y, sizes).astype(float)
        cost = np.repeat(1 / sizes, sizes)  # every document counts the same
        end = np.cumsum(pieces) - 1
        inner = np.ones(len(z), bool)
        inner[end] = False
        i = np.flatnonzero(inner)
        params = np.zeros(z.shape[1] + 4)
        m, v = np.zeros_like(params), np.zeros_like(params)
        for k in range(1, ROUNDS + 1):
            w, t = params[:-4], params[-4:].reshape(2, 2)
            theta = z @ w
            fore, back = chain(theta, pieces, t)
            grad = np.zeros_like(params)
            grad[:-4] = z.T @ (cost * (target - sigmoid(fore + back)))
            right = theta[i + 1] + back[i + 1]
            joint = np.stack([np.zeros(len(i)) + t[0, 0], right + t[0, 1], fore[i] + t[1, 0], fore[i] + right + t[1, 1]], 1)
            joint = np.exp(joint - joint.max(1, keepdims=True))
            joint /= joint.sum(1, keepdims=True)
            seen = np.stack([target[i] == 0, target[i] * 0, target[i] * 0, target[i] == 1], 1)
            grad[-4:] = (cost[i][:, None] * (seen - joint)).sum(0)
            grad = grad / len(sizes) - 1e-3 * params
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            params = params + 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        self.weights, self.moves = params[:-4], params[-4:].reshape(2, 2)
        self.slope, self.shift = platt(self._raw(x, lengths, sizes), y, weight)
        return self

    def _raw(self, x, lengths, sizes) -> np.ndarray:
        fore, back = chain(((x - self.mean) / self.scale) @ self.weights, sizes, self.moves)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        part = np.maximum(lengths, 1e-9)
        good = np.bincount(doc, part * sigmoid(fore + back), len(sizes)) / np.bincount(doc, part, len(sizes))
        good = np.clip(good, 1e-4, 1 - 1e-4)
        return np.log(good / (1 - good))

    def score(self, lines: Lines, column) -> np.ndarray:
        if self.weights is None or not len(column):
            return np.full(len(column), self.base)
        return sigmoid(self.slope * self._raw(*lines(column)) + self.shift)


def fit(documents: DataFrame, labels: DataFrame, excluded: Column, label: str = "quality", per_class: int = 1024) -> QualityModel:
    """Learns from at most ``per_class`` labelled texts of each class."""
    import pyarrow as pa

    sample = labelled_texts(documents, labels.select("doc_id", label), label, per_class, excluded)
    y = np.array([int(c) for _, c, _ in sample])
    weight = class_weight(labels, label, excluded, y)
    base = float((weight * y).sum() / weight.sum()) if len(y) else 0.5
    model = QualityModel(base)
    return model.fit(pa.array([t for t, _, _ in sample]), y, weight) if len(set(y)) == 2 else model


def _scorer(shared):
    model, lines = shared.value, Lines()

    def run(batch):
        import pyarrow as pa

        from_blocks = [model.score(lines, part.column("text")) for part in blocks(batch, 1 << 20)]
        return [pa.array(np.concatenate(from_blocks) if from_blocks else np.zeros(0))]

    return run


def score(documents: DataFrame, model: QualityModel, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``score``, likelier 1 when higher."""
    return map_texts(documents, documents.columns if keep is None else keep, "score double",
                     _scorer, (Shared(documents.sparkSession, model),))
