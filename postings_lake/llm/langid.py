"""Language identification with a blended-spectrum string kernel.

Two texts are compared by the n-grams of up to ``GRAMS`` characters that both
contain (presence, not counts), divided by the root of the product of their
numbers of n-grams. Landmarks, a bounded sample of labelled texts, give the
Nystroem features K(x, L) K(L, L)^(-1/2); kernel ridge regression fits one
language against the rest on them.

The kernel is a product of presence vectors, so landmarks and regression fold
into one weight for each n-gram and language: scoring a batch is one sparse
matrix product, the n-grams of its texts by these weights.

Characters are lowered; every letter is itself, everything else is a gap. An n-gram
is the number that its code points spell (21 bits each), so no two n-grams and no two
alphabets are merged. Texts whose letters are all among the ``FAST`` most frequent of the
sample find their n-grams in a table of flags, others by sorting; both give the same.

Defined cases: a null text or one without a letter is ``und`` with score 0, as
is every text when nothing could be learned; of languages with equal scores the
first in order wins; repeated rows are scored each; texts of any length are read
whole, in pieces; kept columns named as the results are replaced by them, other extra
columns change nothing.
"""
from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame

from postings_lake.llm.common import Shared, labelled_texts, map_texts

GRAMS, FAST, CODES = 3, 62, 64
SIZE = CODES + CODES**2 + CODES**3
GAP, BITS = 1, 21  # a letter is its code point + 2
PIECE = 1 << 20
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Grams:
    """The n-grams of texts as ascending 64-bit keys."""

    def __init__(self, texts: list[str]):
        seen = Counter()
        for t in texts:
            seen.update({c for c in t.lower() if c.isalpha()})
        self.letters = "".join(c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:FAST])

    @classmethod
    def of(cls, letters: str) -> Grams:
        made = cls([])
        made.letters = letters
        return made

    def prepare(self) -> None:
        self.code = np.array([CODES - 1 if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint8)
        for i, c in enumerate(self.letters):
            self.code[ord(c)] = i + 1
        self.flags = np.zeros(SIZE, bool)
        own = np.array([GAP, *[ord(c) + 2 for c in self.letters], *[GAP] * (CODES - 1 - len(self.letters))], np.int64)
        two = (own[:, None] << BITS | own).ravel()
        self.keys = np.concatenate([own, two, (two[:, None] << BITS | own).ravel()])

    def present(self, text: str) -> np.ndarray:
        """The distinct n-grams of a text that hold a letter, ascending."""
        if not hasattr(self, "code"):
            self.prepare()
        parts = []  # of the pieces that have other letters
        for lo in range(0, len(text), PIECE):
            some = np.frombuffer(text[max(0, lo - GRAMS + 1):lo + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            a = self.code[some].astype(np.int32)
            if (a == CODES - 1).any():
                parts.append(self._sorted(some, a > 0))
                continue
            self.flags[a] = True
            two = a[:-1] * CODES + a[1:]
            self.flags[two + CODES] = True
            self.flags[two[:-1] * CODES + a[2:] + (CODES + CODES**2)] = True
        self.flags[[0, CODES, CODES + CODES**2]] = False
        out = np.flatnonzero(self.flags)
        self.flags[out] = False
        return np.unique(np.concatenate([self.keys[out], *parts])) if parts else np.sort(self.keys[out])

    @staticmethod
    def _sorted(points: np.ndarray, letter: np.ndarray) -> np.ndarray:
        a = np.where(letter, points.astype(np.int64) + 2, GAP)
        two = a[:-1] << BITS | a[1:]
        three = two[:-1] << BITS | a[2:]
        with_letter = letter[:-1] | letter[1:]
        return np.unique(np.concatenate([a[letter], two[with_letter], three[with_letter[:-1] | letter[2:]]]))


class LanguageModel:
    """Landmark kernel ridge regression, folded into n-gram weights."""

    def __init__(self, sample: list[tuple[str, str]], landmarks: int, ridge: float = 1e-3):
        self.languages = sorted({lang for _, lang in sample})
        self.grams = Grams([t for t, _ in sample])
        sets = [self.grams.present(t) for t, _ in sample]
        rank, chosen = Counter(), []
        for i, (_, lang) in enumerate(sample):
            if len(sets[i]) and rank[lang] < landmarks:
                rank[lang] += 1
                chosen.append(i)
        self.used = np.zeros(0, np.int64)  # the landmarks' n-grams, ascending; a weight row each, and zeros for others
        self.weights, self.sharpness = np.zeros((1, len(self.languages)), np.float32), 1.0
        if chosen:
            self._fit(sample, sets, chosen, ridge)
        self.grams = Grams.of(self.grams.letters)

    def _fit(self, sample, sets, chosen, ridge) -> None:
        own = np.repeat(np.arange(len(chosen)), [len(sets[i]) for i in chosen])
        keys = np.concatenate([sets[i] for i in chosen])
        order = np.argsort(keys, kind="stable")
        own = own[order]  # the landmarks that hold each n-gram, n-gram by n-gram
        self.used, begin, count = np.unique(keys[order], return_index=True, return_counts=True)
        scale = 1 / np.sqrt([len(sets[i]) for i in chosen])
        begin, count = np.append(begin, len(own)), np.append(count, 0)  # and of none
        kernel = np.zeros((len(sets), len(chosen)))
        for i, s in enumerate(sets):
            at = self.rows(s)
            n = count[at]
            held = own[np.repeat(begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            kernel[i] = np.bincount(held, minlength=len(chosen)) * scale / np.sqrt(max(1, len(s)))
        value, vector = np.linalg.eigh(kernel[chosen])
        root = (vector / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
        phi = kernel @ root
        y = np.array([[1.0 if lang == c else -1.0 for c in self.languages] for _, lang in sample])
        fit = np.linalg.solve(phi.T @ phi + ridge * len(sample) * np.eye(len(chosen)), phi.T @ y)
        self.weights = np.zeros((len(self.used) + 1, len(self.languages)), np.float32)
        folded = scale[:, None] * (root @ fit)
        for c in range(len(self.languages)):
            self.weights[:-1, c] = np.add.reduceat(folded[own, c], begin[:-1])
        self.sharpness = self._sharpness(phi @ fit, y)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The weight row of each n-gram; the last row, of zeros, for unknown ones."""
        at = np.searchsorted(self.used, keys)
        known = at < len(self.used)
        known[known] = self.used[at[known]] == keys[known]
        return np.where(known, at, len(self.used))

    @staticmethod
    def _sharpness(scores: np.ndarray, y: np.ndarray) -> float:
        """The softmax factor under which the sample's labels are likeliest."""
        def loss(b):
            z = b * scores
            z = z - z.max(1, keepdims=True)
            return -(z - np.log(np.exp(z).sum(1, keepdims=True)))[y > 0].mean()

        return min((0.5 * 1.3**k for k in range(16)), key=loss)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        sets = [self.grams.present(t) if has_letter(t) else np.zeros(0, np.int64) for t in texts]
        sizes = np.array([len(s) for s in sets])
        total = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(sizes)
        if len(full) and self.languages:
            begin = np.cumsum(sizes[full]) - sizes[full]
            total[full] = np.add.reduceat(self.weights[self.rows(np.concatenate([sets[i] for i in full]))], begin, axis=0)
        total /= np.sqrt(np.maximum(sizes, 1))[:, None]
        z = np.exp(self.sharpness * (total - total.max(1, keepdims=True, initial=-np.inf)))
        best = z.argmax(1) if self.languages else np.zeros(len(texts), int)
        known = (sizes > 0) & bool(self.languages)
        p = np.where(known, z.max(1, initial=0) / np.maximum(z.sum(1), 1e-30), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], p


def fit(documents: DataFrame, excluded: Column, per_language: int = 256, landmarks: int = 96) -> LanguageModel:
    """Learns from at most ``per_language`` texts of each ``lang``."""
    sample = labelled_texts(documents, documents.select("doc_id", "lang"), "lang", per_language, excluded)
    return LanguageModel([(t, lang) for t, lang, _ in sample], landmarks)


def _predictor(shared):
    model = shared.value

    def run(batch):
        texts = batch.column("text").to_pylist()
        names, scores = [], []
        for lo in range(0, len(texts), 256):
            n, p = model.predict([t or "" for t in texts[lo:lo + 256]])
            names += n
            scores += p.tolist()
        return [names, scores]

    return run


def identify(documents: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``lang_pred`` and ``score``."""
    return map_texts(documents, documents.columns if keep is None else keep, "lang_pred string, score double",
                     _predictor, (Shared(documents.sparkSession, model),))
