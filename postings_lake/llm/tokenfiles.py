"""Token ids in binary files, packed as Simple-8b words.

A 64-bit word holds a selector in its top 4 bits and, in the other 60, as many ids
as the selector says, the first in the lowest bits (``PACKINGS``: count and width
of each selector). Selector 0 is an escape: its 60 bits count the raw 64-bit words
that follow, for ids of more than 60 bits. Each word takes the largest count that
fits (greedy), and every block of ``BLOCK`` ids starts a new word whose place the
record lists, so any block is decoded alone and all words of many blocks at once.

A file is one record, all numbers little-endian, then a line feed (the end mark):
``MAGIC``, seven 64-bit numbers (partition, number within it, documents, documents
without id, ids, blocks, words), then arrays of 64-bit numbers: document ids (those
of the first documents, without id, are 0), the end of each document's ids, the
first word of each block, the words. Files hold whole documents of about
``FILE_IDS`` ids. In order of (partition, number) they hold all documents in
ascending order of ``doc_id``, those without id first and repeated ones in order
of a hash of their text.

Documents are ranged over partitions by id (and, within one id, by hash of the text
and place, so that no id needs a partition of its own), encoded and packed there, and
written by Spark's own commit protocol, one file a record: a lost executor's files are
written anew and never seen twice. Reading gives whole documents back; their places in
the sequence come from two levels of running sums over files, never from one task
that sees all.

The tokenizers library encodes pieces of the texts, each once a task while remembered
(``CACHE_BYTES``). Texts are cut at spaces, tabs and line feeds; what stands between is
cut further by the tokenizer's own pattern where it holds only printable ASCII and common
Latin letters, else it is a piece; texts of such characters alone are cut by the pattern
all at once, as bytes. That equals the library's result on the whole text: its
words are encoded one by one, never reach across white space, and neither do normal forms.

Defined cases: a null text is empty and holds the end id only; repeated documents are
documents of their own; an empty table gives no documents; extra columns, whatever
their names, are ignored; very long texts are one row in memory, and their file is as
long as they need; ``doc_id`` must be an integer column.
"""
from __future__ import annotations

import json
import os
import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postings_lake.llm.common import shared_dir, stored
from postings_lake.llm.textarrays import blocks

# Ids a word and bits an id of selectors 1 to 14 (Simple-8b).
PACKINGS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE, PAYLOAD = 0, 60
_COUNTS, _WIDTHS = (np.array(c) for c in zip(*PACKINGS))
WINDOW = 60  # ids that a word may hold
MAGIC = b"S8BIDS01"
BLOCK = 4096
AT_ONCE = 256  # blocks packed or unpacked at a time
FILE_IDS = 2_000_000
PARTITION_BYTES = 64 << 20  # text bytes a range of ids holds
CACHE_BYTES = 160 << 20
ENCODED_BYTES = 4 << 20  # text bytes encoded at a time
ENTRY_BYTES = 150  # what a remembered piece takes beside its text and ids
FILES_SUMMED = 1024  # partitions of files whose running sums one group makes

# The pattern that the public tokenizer splits lower-case text by, spelt out for code
# points whose class, normal form and lower case are the same in every Unicode version.
LOWER = "a-z\xdf-\xf6\xf8-\xff\u0101\u0103\u0105\u0107\u0111\u0119\u011b\u0131\u0142\u0144\u0151\u0153\u0159\u015b\u0161\u0171\u017a\u017c\u017e"
PLAIN = f"[\r\x21-\x7e{LOWER}\xc0-\xd6\xd8-\xde]*"
PLAIN_TEXT = re.compile(f"[\t\n {PLAIN[1:]}").fullmatch
WHITE, LETTER, DIGIT, OTHER = range(4)
BYTE_CLASS = np.full(256, OTHER, np.int8)  # of the bytes of plain lower-case text
BYTE_CLASS[list(b"\t\n\r ")], BYTE_CLASS[list(b"0123456789")] = WHITE, DIGIT
BYTE_CLASS[97:123] = BYTE_CLASS[128:] = LETTER
WORDS = re.compile(f"[{LOWER}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t\n\r {LOWER}0-9]+")
UNCHANGED = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"})  # leave pieces as they are
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"  # fixed value: as the tokenizer file says


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), ids, "right").astype(np.int8)


_SHORT_LENGTHS = _bit_lengths(np.arange(1 << 16, dtype=np.uint64))


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    """Bits that each uint64 needs (0 for 0)."""
    return _SHORT_LENGTHS[ids] if ids.size and ids.max() < len(_SHORT_LENGTHS) else _bit_lengths(ids)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """Selector of the word that would start at each place (beyond the end lie zeros)."""
    fitting, most, span = np.zeros(len(bits), np.int8), bits.copy(), 1
    for count, width in reversed(PACKINGS):  # counts ascending: where one fits, so do all before it
        while span < count:  # the most bits of the next ``span`` ids
            more = min(span, count - span)
            np.maximum(most[:-more], most[more:], out=most[:-more])
            span += more
        fitting += most <= width
    return np.append(ESCAPE, np.arange(len(PACKINGS), 0, -1)).astype(np.int8)[fitting]


def _pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of some whole blocks (the last may be short) and each block's first word.

    The word that would start at each id is found for all ids at once; then all blocks go
    forward together, from word to word. What lies beyond a block's end counts as zeros, which fit any word.
    """
    n, n_blocks = len(ids), -(-len(ids) // BLOCK)
    width = BLOCK + WINDOW
    value = np.zeros((n_blocks, width), np.uint64)
    whole = n // BLOCK
    value[:whole, :BLOCK] = ids[:whole * BLOCK].reshape(whole, BLOCK)
    value[whole:, :n - whole * BLOCK] = ids[whole * BLOCK:]  # the last row, if short
    value = value.ravel()
    bits = bit_lengths(value)
    selectors = _selectors(bits)
    steps = np.append(0, _COUNTS)[selectors]
    escapes = np.flatnonzero(selectors == ESCAPE)  # ids of more than 60 bits: all that follow each other
    if len(escapes):  # zeros end the last of each block
        short = np.flatnonzero(bits <= PAYLOAD)
        steps[escapes] = short[np.searchsorted(short, escapes)] - escapes
    first = np.arange(n_blocks) * width
    at, end, starts = first, first + BLOCK, np.zeros(len(value), bool)
    end[-1] = first[-1] + n - (n_blocks - 1) * BLOCK
    while len(at):
        starts[at] = True
        at = at + steps[at]
        on = at < end
        if not on.all():
            at, end = at[on], end[on]
    starts = np.flatnonzero(starts)
    selector, step = selectors[starts], steps[starts]
    size = np.where(selector == ESCAPE, 1 + step, 1)
    where = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s, (count, bits_each) in enumerate(PACKINGS, 1):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            packed = np.full(len(mine), np.uint64(s) << np.uint64(PAYLOAD))
            for k in range(count):
                packed |= value[starts[mine] + k] << np.uint64(k * bits_each)
            words[where[mine]] = packed
    for i in np.flatnonzero(selector == ESCAPE):
        w, run = int(where[i]), int(step[i])
        words[w] = run
        words[w + 1:w + 1 + run] = value[starts[i]:starts[i] + run]
    return words, where[np.searchsorted(starts, first)]


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, first word of each block)`` of uint64 ``ids``."""
    words, firsts, total = [], [], 0
    for lo in range(0, len(ids), AT_ONCE * BLOCK):
        some, first = _pack(ids[lo:lo + AT_ONCE * BLOCK])
        words.append(some)
        firsts.append(first + total)
        total += len(some)
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(words), np.concatenate(firsts)


def _unpack(words: np.ndarray, firsts: np.ndarray, n: int) -> np.ndarray:
    selector = (words >> np.uint64(PAYLOAD)).astype(np.int64)
    header, after = np.ones(len(words), bool), 0
    for w in np.flatnonzero(selector == ESCAPE):
        if w >= after:  # else it is a raw word of the escape before
            after = w + 1 + int(words[w])
            header[w + 1:after] = False
    if (selector[header] > len(PACKINGS)).any():
        raise ValueError("not a Simple-8b word")
    counts = np.array([0] + [c for c, _ in PACKINGS] + [0])[selector]
    escapes = header & (selector == ESCAPE)
    counts[escapes] = words[escapes].astype(np.int64)
    counts[~header] = 0
    before = np.cumsum(counts) - counts  # ids before each word, as if no block ended early
    block = np.searchsorted(firsts, np.arange(len(words)), "right") - 1
    start = before - before[firsts][block] + block * BLOCK
    keep = np.minimum(counts, np.minimum((block + 1) * BLOCK, n) - start)
    out = np.zeros(n, np.uint64)
    for s, (count, width) in enumerate(PACKINGS, 1):
        mine = np.flatnonzero(header & (selector == s))
        if len(mine):
            value = words[mine][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))
            value &= np.uint64((1 << width) - 1)
            inside = np.arange(count) < keep[mine][:, None]
            out[(start[mine][:, None] + np.arange(count))[inside]] = value[inside]
    for w in np.flatnonzero(escapes):
        out[start[w]:start[w] + counts[w]] = words[w + 1:w + 1 + counts[w]]
    return out


def unpack(words: np.ndarray, firsts: np.ndarray, n: int, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids of blocks ``first_block`` to ``last_block`` (excluded; default: all)
    of a record of ``n`` ids; only those blocks' words are looked at."""
    stop = len(firsts) if last_block is None else min(last_block, len(firsts))
    edge, out = np.append(firsts, len(words)), []
    for b in range(first_block, stop, AT_ONCE):
        e = min(b + AT_ONCE, stop)
        out.append(_unpack(words[edge[b]:edge[e]], firsts[b:e] - firsts[b], min(e * BLOCK, n) - b * BLOCK))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def to_record(partition: int, number: int, docs: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """One file's bytes, without the end mark. Documents without id come first."""
    words, firsts = pack(ids.astype(np.uint64))
    unnamed = sum(d is None for d in docs)
    head = np.array([partition, number, len(docs), unnamed, len(ids), len(firsts), len(words)], "<u8")
    return b"".join([MAGIC, head.tobytes(), np.array([d or 0 for d in docs], "<i8").tobytes(),
                     np.cumsum(np.array(sizes, np.int64)).astype("<u8").tobytes(),
                     firsts.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


class Record:
    """A file's bytes, parsed; ids are decoded on demand."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a file of token ids")
        self.partition, self.number, n, self.unnamed, self.n_ids, n_blocks, n_words = map(int, np.frombuffer(content, "<u8", 7, 8))
        at = [64]

        def array(count: int, kind: str) -> np.ndarray:
            out = np.frombuffer(content, kind, count, at[0])
            at[0] += 8 * count
            return out

        self.docs = array(n, "<i8")
        self.ends = array(n, "<u8").astype(np.int64)
        self.firsts = array(n_blocks, "<u8").astype(np.int64)
        self.words = array(n_words, "<u8")
        if content[at[0]:] != b"\n":
            raise ValueError("a file of token ids is cut off")

    def ids(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids ``lo`` to ``hi`` (excluded) of the record."""
        hi = self.n_ids if hi is None else hi
        b = lo // BLOCK
        return unpack(self.words, self.firsts, self.n_ids, b, -(-hi // BLOCK))[lo - b * BLOCK:hi - b * BLOCK]


def cut_plain(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of plain lower-case texts, as ``WORDS`` finds them: their bytes one after the
    other, where each begins, and the first piece of each text (and behind the last)."""
    data = np.frombuffer(b"\n".join([*texts, b"\n\n"]), np.uint8)
    kind = BYTE_CLASS[data]
    starts = kind == DIGIT
    starts[0] |= kind[0] != WHITE
    starts[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] != WHITE)
    quote = np.flatnonzero(data == ord("'"))
    quote = quote[starts[quote] & (kind[quote + 1] == LETTER)]  # alone before a letter
    one, two = data[quote + 1], data[quote + 1].astype(np.int64) << 8 | data[quote + 2]
    long = np.isin(two, [int.from_bytes(w) for w in (b"re", b"ve", b"ll")])
    short = np.isin(one, list(b"stmd"))
    for some, length in ((quote[short], 2), (quote[long], 3)):
        starts[some + 1] = False
        starts[some + length] |= kind[some + length] == LETTER
    inside = kind != WHITE
    text = np.cumsum([0] + [len(t) + 1 for t in texts])
    return data[inside], np.flatnonzero(starts[inside]), np.searchsorted(np.flatnonzero(starts), text)


class WordIds:
    """``words``: what stands between spaces -> its ids (little-endian unsigned 32-bit), by
    the tokenizers library; ``pieces``: the same of the words within that its pattern finds."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        lower = {"type": "Lowercase"} in (spec.get("normalizer") or {}).get("normalizers", [])
        suffix = spec["model"].get("end_of_word_suffix")
        if not lower or not suffix or split.get("pattern") != {"Regex": SPLIT} or not split.get("invert") or split.get("behavior") != "Removed":
            raise ValueError("only tokenizers that lower-case, drop white space by this pattern and mark the ends of words are supported")
        self.library, self.pieces, self.held = Tokenizer.from_str(tokenizer), {}, 0
        self.words: dict[str, bytes] = {"": b""}
        # Pieces are cut and lower-case already: where the normal forms leave them as they are, only the rest is done.
        self.library_of_pieces = self.library
        if all(n in UNCHANGED for n in spec["normalizer"]["normalizers"]):
            rest = spec["pre_tokenizer"]["pretokenizers"][1:]
            lean = {"normalizer": None, "added_tokens": [],
                    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *rest]}}
            self.library_of_pieces = Tokenizer.from_str(json.dumps(spec | lean))
        for library in (self.library, self.library_of_pieces):
            library.no_truncation()
            library.no_padding()
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # whether an id ends a word
        self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        added = "|".join(map(re.escape, self.added))
        self.plain = re.compile(f"(?!.*(?:{added})){PLAIN}" if added else PLAIN, re.DOTALL).fullmatch

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids."""
        if self.held + ENTRY_BYTES * (len(self.words) + len(self.pieces)) > CACHE_BYTES:  # forget all, and learn anew
            self.words, self.pieces, self.held = {"": b""}, {}, 0
        plain = [PLAIN_TEXT(t) is not None and not any(a in t for a in self.added) for t in texts]
        coded = iter(self.encode_plain([t for t, p in zip(texts, plain) if p]))
        split = [None if p else t.replace("\n", " ").replace("\t", " ").split(" ") for t, p in zip(texts, plain)]
        new = list(set().union(*filter(None, split)).difference(self.words))
        for lo in range(0, len(new), 2048):
            self.learn(new[lo:lo + 2048])
        word = self.words.__getitem__
        return [next(coded) if words is None else b"".join(map(word, words)) for words in split]

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that are plain from end to end."""
        import pyarrow as pa

        raw = [t.lower().encode() for t in texts]  # of as many bytes as before
        data, at, first = cut_plain(raw)
        if not len(at):
            return [b""] * len(texts)
        ends = np.append(at, len(data))
        found = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        pieces, place = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
        known = list(map(self.pieces.get, pieces))
        new = [k for k, ids in enumerate(known) if ids is None]
        self.learn_pieces([pieces[k] for k in new])
        for k in new:
            known[k] = self.pieces[pieces[k]]
        flat, size = np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4
        begin, count = np.cumsum(size) - size, size[place]
        after = np.append(0, np.cumsum(count))  # ids before each piece
        ids = flat[np.repeat(begin[place] - after[:-1], count) + np.arange(after[-1])].tobytes()
        edges = (4 * after[first]).tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:])]

    def learn(self, words: list[str]) -> None:
        plain, odd = [], []
        for w in words:
            (plain if self.plain(w) else odd).append(w)
        found = [WORDS.findall(w.lower()) for w in plain]
        self.learn_pieces(list({p for pieces in found for p in pieces}.difference(self.pieces)))
        for w, pieces in zip(plain, found):
            ids = self.words[w] = b"".join(map(self.pieces.__getitem__, pieces))
            self.held += len(w) + len(ids)
        if odd:
            coded = self.library.encode(odd, is_pretokenized=True, add_special_tokens=False)
            word = np.array([-1 if w is None else w for w in coded.word_ids], np.int64)
            self._keep(self.words, odd, np.array(coded.ids, "<u4"), np.searchsorted(word, np.arange(len(odd) + 1)))

    def learn_pieces(self, new: list[str]) -> None:
        """Remember pieces not known yet, each named once."""
        for lo in range(0, len(new), 64):  # one word each: its last id says where it ends
            some = new[lo:lo + 64]
            ids = np.array(self.library_of_pieces.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            self._keep(self.pieces, some, ids, np.append(0, np.flatnonzero(self.ends[ids]) + 1))

    def _keep(self, into: dict, texts: list[str], ids: np.ndarray, cut: np.ndarray) -> None:
        if len(cut) != len(texts) + 1:
            raise ValueError("the tokenizer does not end each word with its suffix")
        flat, cut = ids.tobytes(), (4 * cut).tolist()
        into.update(zip(texts, [flat[a:b] for a, b in zip(cut, cut[1:])]))
        self.held += len(flat) + sum(map(len, texts))


def _written(batches, tokenizer: str, end_id: int, file_ids: int):
    """Records of a partition's documents, in their order."""
    import pyarrow as pa
    from pyspark import TaskContext

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    known, end = WordIds(tokenizer), np.array([end_id], "<u4").tobytes()
    partition, number = TaskContext.get().partitionId(), 0
    docs, sizes, parts, held = [], [], [], 0

    def record():
        ids = np.frombuffer(b"".join(parts), "<u4")
        return pa.RecordBatch.from_arrays([pa.array([to_record(partition, number, docs, sizes, ids)], pa.binary())], names=["record"])

    for batch in batches:
        for part in blocks(batch, ENCODED_BYTES):
            coded = known.encode([t or "" for t in part.column("text").to_pylist()])
            for doc, ids in zip(part.column("doc_id").to_pylist(), coded):
                docs.append(doc)
                sizes.append(len(ids) // 4 + 1)
                parts += ids, end
                held += sizes[-1]
                if held >= file_ids:
                    yield record()
                    number, held, docs, sizes, parts = number + 1, 0, [], [], []
    if docs:
        yield record()


def write(documents: DataFrame, tokenizer_file: str, path: str, end_id: int, file_ids: int = FILE_IDS) -> None:
    """Encode ``documents`` (``doc_id``, ``text``), append ``end_id`` to each, and
    write them in order under ``path``. The driver reads ``tokenizer_file``."""
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer = f.read()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("n")).first()["n"]
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("same"), F.monotonically_increasing_id().alias("place"))
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "same", "place")]
    ranged = keyed.repartitionByRange(max(1, -(-size // PARTITION_BYTES)), *order).sortWithinPartitions(*order)
    records = ranged.select("doc_id", "text").mapInArrow(lambda b: _written(b, tokenizer, end_id, file_ids), "record binary")
    # The text writer copies a string's bytes as they are and ends each with a line feed.
    records.select(F.col("record").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def _read(batches):
    import pyarrow as pa

    for batch in batches:
        for content in batch.column(0):
            r = Record(content.as_py())
            ends, lo = r.ends, 0
            while lo < len(ends):  # about 1 MB of ids at a time
                first = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, first + (1 << 18), "right")))
                ids = r.ids(first, int(ends[hi - 1])).astype("<u4")
                cut = np.concatenate([[first], ends[lo:hi]]) - first
                flat = ids.tobytes()
                n = hi - lo
                docs = pa.array(r.docs[lo:hi], mask=np.arange(lo, hi) < r.unnamed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, r.partition)), pa.array(np.full(n, r.number)), pa.array(np.arange(lo, hi)), docs,
                     pa.array(cut[:-1] + first), pa.array([flat[4 * a:4 * b] for a, b in zip(cut, cut[1:])], pa.binary())],
                    names=["partition", "number", "position", "doc_id", "offset", "ids"])
                lo = hi


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files under ``path``: ``partition, number`` of the file,
    ``position`` in it, ``doc_id``, ``offset`` of the first id in the file, and
    ``ids`` (binary, little-endian unsigned 32-bit)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read, "partition long, number long, position long, doc_id long, offset long, ids binary")


def with_starts(measured: DataFrame) -> DataFrame:
    """Adds ``start``, the number of ids before each document in the whole sequence.

    ``measured`` (``partition, number, offset, n_tokens``, one row a document) is
    read twice. Files are summed map-side, then in groups of ``FILES_SUMMED``
    partitions each, then the groups: one task sees one row for each group.
    """
    files = measured.groupBy("partition", "number").agg(F.sum("n_tokens").alias("n"))
    files = files.withColumn("grp", F.floor(F.col("partition") / FILES_SUMMED))
    groups = files.groupBy("grp").agg(F.sum("n").alias("n"))
    every = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("grp", F.coalesce(F.sum("n").over(every), F.lit(0)).alias("before_group"))
    inside = Window.partitionBy("grp").orderBy("partition", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("grp", "partition", "number", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("before_file"))
    files = files.join(groups, "grp").select("partition", "number", (F.col("before_group") + F.col("before_file")).alias("before"))
    return measured.join(files, ["partition", "number"]).withColumn("start", F.col("before") + F.col("offset")).drop("before")


def round_trip(documents: DataFrame, tokenizer_file: str, end_id: int, path: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write, read back and measure: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = documents.sparkSession
    path = path or f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write(documents, tokenizer_file, path, end_id, file_ids)
    measured = stored(read(spark, path).select(
        "partition", "number", "doc_id", "offset", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32")), "token-index")
    return with_starts(measured).select("doc_id", "start", "n_tokens", "ids_crc32")
