"""Fill-in-the-middle documents, cut by memoized content-defined chunks.

A text is cut into prefix, middle and suffix between units: code points, or words
(a word and the white space after it). A unit starts at a byte, as its kind's
``starts`` table says from the byte and the one before it, so units are matched from
left to right.

Texts are split into chunks where a rolling hash of the last 32 bytes has its upper
``CHUNK_BITS`` bits zero (never less than ``LEAST`` bytes after the last split, at
most ``MOST``). Splits depend on nearby content alone, so passages that documents
share fall into equal chunks wherever they stand. A chunk's boundary summary is
its first and last byte's class and the number of units that start after its first
byte; whether one starts at the first byte itself depends on the chunk before. Summaries
are kept by the chunk's content (a chunk is found only by equal bytes; ``CACHE_BYTES``
bound the store), so shared chunks are counted once a task. Combining them gives the
units before every chunk; the chunk that holds a cut is the only one searched.

Where the cuts are, and which form a document gets, follows from the sha256 of
``seed:doc_id``, so runs and retries agree. A text that holds a sentinel stays plain,
or it could not be taken apart again.

Defined cases: a null text is empty, an empty text stays plain; a null ``doc_id``
draws as an empty one; rows are independent, so repeated rows give repeated results;
very long texts are handled whole, chunk by chunk; an empty table gives an empty result;
a kept column whose name is that of a result column is replaced by the result.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings_lake.llm.common import map_texts
from postings_lake.llm.textarrays import mix64, strings

# Fixed values of the output: sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LEAST, MOST, CHUNK_BITS = 64, 8192, 9
CACHE_BYTES = 64 << 20
ENTRY_BYTES = 250  # what a remembered chunk takes beside its bytes

_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def _points() -> tuple[np.ndarray, np.ndarray]:
    """Code points start at every byte that continues none."""
    kind = (np.arange(256) & 0xC0 == 0x80).astype(np.uint8)  # 1: continuation
    return kind, np.array([[True, False], [True, False]])


def _words() -> tuple[np.ndarray, np.ndarray]:
    """Words start at a byte that is no white space, after one that is."""
    kind = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32]).astype(np.uint8)  # 1: white space
    return kind, np.array([[False, False], [True, False]])


#: name -> (class of each byte, whether a unit starts at [class before, class]); a
#: text's first byte always starts one.
UNITS = {"code points": _points(), "words": _words()}


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes up to each byte (fewer at the beginning), by doubling."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)  # the right side is made before it is added
    return h


def splits(data: np.ndarray, at: np.ndarray) -> list[list[int]]:
    """For each text (offsets ``at``) the ends of its chunks, relative to its start."""
    marks = np.flatnonzero(rolling(data[at[0]:at[-1]]) < np.uint32(1 << (32 - CHUNK_BITS))) + 1 + at[0]
    first = np.searchsorted(marks, at[:-1] + LEAST)
    last = np.searchsorted(marks, at[1:])
    marks, out = marks.tolist(), []
    for lo, hi, a, b in zip(at[:-1].tolist(), at[1:].tolist(), first.tolist(), last.tolist()):
        ends, end = [], lo
        for m in marks[a:b]:
            while m - end > MOST:
                end += MOST
                ends.append(end - lo)
            if m - end >= LEAST:
                end = m
                ends.append(end - lo)
        while hi - end > MOST:
            end += MOST
            ends.append(end - lo)
        if hi > end:
            ends.append(hi - lo)
        out.append(ends)
    return out


class Counter(dict):
    """Chunk bytes -> ``(class of the first byte, of the last, units after the first byte)``."""

    def __init__(self, unit: str):
        super().__init__()
        self.kind, self.starts = UNITS[unit]
        self.flat = self.starts.ravel()
        self.begins = self.starts.tolist()
        self.held = self.found = self.asked = 0

    def inside(self, chunk: bytes) -> np.ndarray:
        """Whether a unit starts at each byte but the first."""
        kind = self.kind[np.frombuffer(chunk, np.uint8)]
        return self.flat[2 * kind[:-1] + kind[1:]]

    def __missing__(self, chunk: bytes) -> tuple[int, int, int]:
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        self.found += 1
        self.held += len(chunk) + ENTRY_BYTES
        summary = self[chunk] = int(self.kind[chunk[0]]), int(self.kind[chunk[-1]]), int(np.count_nonzero(self.inside(chunk)))
        return summary

    def measure(self, text: bytes, ends: list[int]) -> "Measured":
        """The units before each chunk of a text, from its chunks' summaries."""
        self.asked += len(ends)
        before, units, last, lo = [0], 0, None, 0
        for hi in ends:
            first, this, n = self[text[lo:hi]]
            units += n + (last is None or self.begins[last][first])
            before.append(units)
            last, lo = this, hi
        return Measured(self, text, ends, before)


class Measured:
    def __init__(self, counter: Counter, text: bytes, ends: list[int], before: list[int]):
        self.counter, self.text, self.ends, self.before = counter, text, ends, before
        self.units = before[-1]

    def place(self, unit: int) -> int:
        """The byte at which ``unit`` (from 0) starts; the text's end for those beyond."""
        if unit >= self.units:
            return len(self.text)
        c = int(np.searchsorted(self.before, unit, "right")) - 1
        lo, k = self.ends[c - 1] if c else 0, unit - self.before[c]
        chunk = self.text[lo:self.ends[c]]
        kind = self.counter.kind
        if c == 0 or self.counter.begins[kind[self.text[lo - 1]]][kind[chunk[0]]]:
            if k == 0:
                return lo
            k -= 1
        return lo + 1 + int(np.flatnonzero(self.counter.inside(chunk))[k])


def rebuild(output: str, form: str) -> str:
    """The text of an output, or an error if it does not fit its form."""
    if form == "plain":
        return output
    head, inner = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(head):
        raise ValueError("the output does not begin with its sentinel")
    first, found, rest = output[len(head):].partition(inner)
    second, found_too, middle = rest.partition(MIDDLE)
    if not found or not found_too:
        raise ValueError("the output lacks a sentinel")
    return first + middle + second if form == "psm" else second + middle + first


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """The first four 32-bit groups of the sha256 of ``seed:doc_id``, as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _cutter(unit: str, middle_percent: int, spm_percent: int):
    counter = Counter(unit)

    def run(batch):
        data, at = strings(batch.column("text"))
        h = [batch.column(f"__h{k}").to_pylist() for k in range(1, 5)]
        raw = data.tobytes() if len(at) > 1 else b""
        columns = [[] for _ in range(7)]
        for i, ends in enumerate(splits(data, at)):
            text = raw[at[i]:at[i + 1]]
            measured = counter.measure(text, ends)
            n = measured.units
            plain = not text or any(s.encode() in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2][i] % 100 >= middle_percent
            if plain:
                row = n, "plain", None, None, None, text.decode(), text.decode()
            else:
                a, b = sorted((h[0][i] % (n + 1), h[1][i] % (n + 1)))
                x, y = measured.place(a), measured.place(b)
                p, m, s = text[:x].decode(), text[x:y].decode(), text[y:].decode()
                form = "spm" if h[3][i] % 100 < spm_percent else "psm"
                out = PREFIX + p + SUFFIX + s + MIDDLE + m if form == "psm" else SUFFIX + s + PREFIX + p + MIDDLE + m
                row = n, form, a, b - a, n - b, out, rebuild(out, form)
            for column, value in zip(columns, row):
                column.append(value)
        return columns

    return run


_cutter.reads = ("__h1", "__h2", "__h3", "__h4")


def transform(documents: DataFrame, keep: list[str] | None = None, unit: str = "code points", middle_percent: int = 90,
              spm_percent: int = 20, seed: int = 1) -> DataFrame:
    """``keep`` columns (default: all) plus ``n`` (units), ``form`` (``plain``, ``psm`` or
    ``spm``), ``prefix_units``, ``middle_units``, ``suffix_units`` (null if plain),
    ``output`` and ``restored`` (the text rebuilt from output and form).

    ``middle_percent`` of the documents that can be cut are, ``spm_percent`` of these
    with the suffix first.
    """
    h = {f"__h{k}": c for k, c in enumerate(draws(F.col("doc_id"), seed), 1)}
    fields = "n long, form string, prefix_units long, middle_units long, suffix_units long, output string, restored string"
    return map_texts(documents.withColumns(h), documents.columns if keep is None else keep, fields, _cutter,
                     (unit, middle_percent, spm_percent))
