"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every word sequence that occurs inside any benchmark item.
Training texts stream through it; at each word it knows the longest sequence
ending there that some item contains. A window is ``window`` consecutive item
words (a shorter item is one window); words inside an occurrence of a window
are hit, and a document is contaminated when its hit words reach ``coverage``
of its words.

Stretches whose neighbouring word pairs no item contains cannot hold a match
longer than one word, so numpy finds the remaining stretches first (by 64-bit
word hashes) and only those are walked, word by word and by the words' real
bytes.

Size: the benchmark is processed in blocks of at most ``BLOCK_WORDS`` words;
each block is one automaton, broadcast, and one pass over the documents.

Defined cases: a null or empty text or item has no words; items that share an
``item_id`` count once; a null ``item_id`` is the empty string; no items, no
hits. Repeated documents are judged one by one; kept columns named as the results are
replaced by them.
"""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings_lake.llm.common import Shared, map_texts, stored
from postings_lake.llm.textarrays import Words, alnum_words, strings

BLOCK_WORDS = 1_000_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: A-Z lowered; digits, a-z and all beyond ASCII."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class ItemAutomaton:
    """Generalised suffix automaton over the words of ``(item_id, words)`` pairs."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        coded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for i, ws in items if ws]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, seq in coded:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        self.windows: dict[int, set[str]] = {}  # state of a full window -> its items
        self.whole: dict[int, dict[int, set[str]]] = {}  # state -> length -> short items
        for item, seq in coded:
            state = size = 0
            for w in seq:
                state, size = self.step(state, size, w)
                if size >= window:
                    self.windows.setdefault(self._window_state(state), set()).add(item)
            if len(seq) < window:
                self.whole.setdefault(state, {}).setdefault(len(seq), set()).add(item)
        self.shortest = min((min(len(s), window) for _, s in coded), default=0)
        self.pairs = np.unique(np.array([a << 32 | b for _, s in coded for a, b in zip(s, s[1:])], np.int64))

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _redirect(self, p: int, w: int, old: int, new: int) -> None:
        while p >= 0 and self.next[p].get(w) == old:
            self.next[p][w] = new
            p = self.link[p]

    def _split(self, p: int, w: int) -> int:
        """The state of exactly p's longest sequence followed by ``w``."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = twin
        self._redirect(p, w, q, twin)
        return twin

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        fresh = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = fresh
            p = self.link[p]
        if p >= 0:
            self.link[fresh] = self._split(p, w)
        return fresh

    def step(self, state: int, size: int, w: int) -> tuple[int, int]:
        """Longest match after one more word."""
        while state and w not in self.next[state]:
            state = self.link[state]
            size = self.length[state]
        if w in self.next[state]:
            return self.next[state][w], size + 1
        return 0, 0

    def _window_state(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, stretch: list[bytes]):
        """``(hit length ending at each word, items found)`` of a word sequence."""
        state = size = 0
        lengths, found = [], set()
        for word in stretch:
            w = self.vocabulary.get(word, -1)
            state, size = self.step(state, size, w)
            hit = 0
            if size >= self.window:
                hit = self.window
                found |= self.windows[self._window_state(state)]
            if self.whole:
                up = state
                while up > 0:
                    for n, items in self.whole.get(up, {}).items():
                        if n <= size:
                            hit = max(hit, n)
                            found |= items
                    up = self.link[up]
            lengths.append(hit)
        return lengths, found


def stretches(automaton: ItemAutomaton, hashes: np.ndarray, codes: np.ndarray, h: np.ndarray, doc: np.ndarray):
    """Ranges ``(from, to)`` of words that may hold a match."""
    if not len(hashes) or not len(h):
        return np.zeros((0, 2), np.int64)
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    known = hashes[at] == h
    code = codes[at]
    joined = known[:-1] & known[1:] & (doc[:-1] == doc[1:])
    i = np.flatnonzero(joined)
    if len(automaton.pairs):
        pair = code[i] << 32 | code[i + 1]
        p = np.minimum(np.searchsorted(automaton.pairs, pair), len(automaton.pairs) - 1)
        joined[i] = automaton.pairs[p] == pair
    else:
        joined[:] = False
    begin = known.copy()
    begin[1:] &= ~joined
    finish = known.copy()
    finish[:-1] &= ~joined
    out = np.stack([np.flatnonzero(begin), np.flatnonzero(finish) + 1], 1)
    return out[out[:, 1] - out[:, 0] >= automaton.shortest]


def _matcher(shared, cut=None):
    automaton = shared.value
    finder = Words(alnum_words())
    raw = b" ".join(automaton.vocabulary)
    _, _, hashes = finder.all(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    order = np.argsort(hashes)
    hashes, codes = hashes[order], order.astype(np.int64)

    def run(batch):
        data, at = strings(batch.column("text"))
        s, e, h = finder.all(data, at)
        doc = np.searchsorted(at, s, "right") - 1
        first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        before = "hit_words" in batch.schema.names
        hits = [set(x) for x in batch.column("hit_words").to_pylist()] if before else [()] * batch.num_rows
        items = [set(x) for x in batch.column("items").to_pylist()] if before else [()] * batch.num_rows
        for lo, hi in stretches(automaton, hashes, codes, h, doc).tolist():
            lengths, found = automaton.scan([data[a:b].tobytes().lower() for a, b in zip(s[lo:hi], e[lo:hi])])
            if found:
                d = int(doc[lo])
                hits[d], items[d] = set(hits[d]), set(items[d]) | found
                for k, n in enumerate(lengths):
                    hits[d].update(range(lo + k + 1 - n - int(first[d]), lo + k + 1 - int(first[d])))
        hits = [sorted(x) for x in hits]
        out = [np.diff(first), hits, [sorted(x, key=lambda v: v.encode()) for x in items]]
        if cut:
            out.append([without_spans(data, int(at[d]), int(at[d + 1]), s[first[d]:], e[first[d]:], hit, cut) for d, hit in enumerate(hits)])
        return out

    return run


def _with_hits(shared, cut=None):
    return _matcher(shared, cut)


_with_hits.reads = ("hit_words", "items")


def find_hits(documents: DataFrame, benchmark: DataFrame, window: int = 13,
              keep: list[str] | None = None, block_words: int = BLOCK_WORDS, cut: int | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``n_words`` (long), ``hit_words``
    (positions of hit words, ascending) and ``items`` (ids of items with an
    occurring window, sorted as strings). With ``cut`` also ``cleaned``, as
    ``remove_spans`` makes it of spans of ``cut`` or more words, in the same pass."""
    spark = documents.sparkSession
    keep = documents.columns if keep is None else keep
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").alias("body")).filter(F.col("body").isNotNull()).distinct()
    # Words are at most as many as half the characters; a cheap upper bound.
    chars = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-chars // (2 * block_words)))
    out = documents
    for b in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks)) == b).collect()
        automaton = ItemAutomaton(sorted((r["item"], words_of(r["body"])) for r in rows), window)
        if b:
            out = stored(out, "hits")
        last = cut if b == n_blocks - 1 else None
        fields = "n_words long, hit_words array<int>, items array<string>" + (", cleaned string" if last else "")
        out = map_texts(out, keep + ["text"], fields, _with_hits if b else _matcher, (Shared(spark, automaton), last))
    return out if "text" in keep else out.drop("text")


def judge(hits: DataFrame, coverage: int = 20) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated``: hit words are 1 in ``coverage`` or more."""
    n_hit = F.size("hit_words").cast("long")
    return hits.withColumns({"n_hit": n_hit, "contaminated": (n_hit > 0) & (F.lit(coverage) * n_hit >= F.col("n_words"))})


def without_spans(data: np.ndarray, lo: int, hi: int, s: np.ndarray, e: np.ndarray, hit: list[int], least: int) -> str:
    """The text at ``lo:hi``, whose words start and end at ``s`` and ``e``, without its
    runs of ``least`` or more ``hit`` words (positions, ascending)."""
    pieces, pos = [], lo
    for run in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1) if hit else ():
        if len(run) >= least:
            pieces.append(data[pos:s[run[0]]].tobytes())
            pos = int(e[run[-1]])
    return (b"".join(pieces) + data[pos:hi].tobytes()).decode("utf-8", "replace")


def _cutter(least):
    finder = Words(alnum_words())

    def run(batch):
        data, at = strings(batch.column("text"))
        out = []
        for d, hit in enumerate(batch.column("hit_words").to_pylist()):
            s, e, _ = finder.all(data, at[d:d + 2]) if hit else (None, None, None)
            out.append(without_spans(data, int(at[d]), int(at[d + 1]), s, e, hit, least))
        return [out]

    return run


_cutter.reads = ("hit_words",)


def remove_spans(hits: DataFrame, least: int = 1) -> DataFrame:
    """Adds ``cleaned``: the text without its spans of ``least`` or more hit words (each
    from the first to the last word of a run of them); an empty string for a null text."""
    return map_texts(hits, hits.columns, "cleaned string", _cutter, (least,))


def brute_force(documents: list[tuple], items: list[tuple], window: int = 13) -> dict:
    """``doc_id -> (n_words, n_hit, sorted items)`` by comparing every window (tests)."""
    grams: dict[tuple, set] = {}
    for item, text in items:
        ws = words_of(text)
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            grams.setdefault(tuple(ws[k:k + n]), set()).add("" if item is None else str(item))
    out = {}
    for doc, text in documents:
        ws, hit, found = words_of(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(ws) - n + 1):
                if (g := tuple(ws[k:k + n])) in grams:
                    found |= grams[g]
                    hit.update(range(k, k + n))
        out[doc] = (len(ws), len(hit), sorted(found, key=str.encode))
    return out
