"""Byte-level BPE by a tokenization automaton.

The automaton reads tokens: its states are the tokens (the last one read) and an
arc u -> v says that v may follow u in a correct tokenization. It starts with
all arcs between single bytes. Each merge (a, b) -> c, in order of rank, is one
gadget: the arc a -> b goes, and a state c appears whose outgoing arcs are those
of b and whose incoming arcs are those of a at that moment.

A dense table of all arcs would need 50,000 squared bits, so the gadgets are
kept as they were applied: for each token its birth (the rank of its merge), the
chain of tokens its outgoing arcs came from (right parts) and the chain its
incoming arcs came from (left parts), and for each removed arc the rank that
removed it. ``arc`` replays the two chains in order of birth and finds whether
the pair standing at that time was ever removed; answers are tabled.

Words (split off by the tokenizer's pattern) are encoded by the one path of arcs
that spells them: a byte trie lists the tokens that start at a position, the
longest that an arc allows is taken, and positions without a way on are marked
dead. A prefix has only one correct tokenization, so a position is only ever
reached from one state. Decoding emits the byte labels of the arcs.

Added tokens found in a text are split off first, as the library does. Letters,
numbers and white space are what the tokenizers library takes for them: its class of every
code point is asked for when the automaton is compiled, and code points of which the
pattern library knows another class are matched through a stand-in of the right one.

Defined cases: a null text is empty and gives no tokens; very long texts are
split into words by an iterator, so no list of all words is built; rows are
independent, so repeated rows and extra columns, whatever their names, change nothing
(a kept column named as a result is replaced by it).
"""
from __future__ import annotations

import json
import re
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame

from postings_lake.llm.common import Shared, map_texts

# Fixed value: the pattern that the public byte-level tokenizer splits words by.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_BYTES = 72 << 20  # words and ids that a task remembers, about; then it starts anew
ENTRY_BYTES = 150  # what a remembered word takes beside its characters and ids
TABLED_ARCS = 300_000
LONG_TEXT = 1 << 20
DECODED_IDS = 1 << 18

# The same pattern over code points below U+0250, where the classes are short
# enough to spell out; Python's own matcher is several times faster on it.
LETTER, NUMBER, SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_PATTERN = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
                 f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


STAND_INS = {"L": "\u00e9", "N": "\u00b2", "S": "\u2003", "O": "\u00a7"}  # one code point of each class


def classes_known(found) -> str:
    """The class of every code point (``L``, ``N``, ``S`` or ``O``; surrogates ``O``), where
    ``found(text)`` gives the pieces of a text that the pattern finds."""
    out = bytearray(b"O" * 0x110000)
    for lo in range(0, 0x110000, 1 << 14):  # some at a time: the driver's memory is small
        points = [c for c in range(lo, lo + (1 << 14)) if not 0xD800 <= c < 0xE000 and c not in (0x20, 0x27)]
        at = 0
        for piece in found("".join(map(chr, points))):  # a piece has code points of one class
            c = piece[0]
            if found(f"a{c}1") == [f"a{c}", "1"]:
                kind = "L"
            elif found(f"a{c}1") == ["a", f"{c}1"]:
                kind = "N"
            else:
                kind = "O" if found(f"!{c}!") == [f"!{c}!"] else "S"
            for k in range(at, at + len(piece)):
                out[points[k]] = ord(kind)
            at += len(piece)
        if at != len(points):
            raise ValueError("the pattern does not cover every text")
    out[0x20] = ord("S")
    return out.decode()


def stand_ins(pre_tokenizer) -> dict[int, str]:
    """Code points whose class the tokenizers library and the pattern library see
    differently, and a stand-in of the class that counts."""
    import regex

    def library(text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in pre_tokenizer.pre_tokenize_str(text)]

    want, have = classes_known(library), classes_known(regex.compile(WORD_PATTERN).findall)
    return {c: STAND_INS[w] for c, (w, h) in enumerate(zip(want, have)) if w != h}


def ranges(points) -> str:
    """A character class of some code points."""
    points, out = sorted(points), []
    for c in points:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else
    the next code point from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenAutomaton:
    """Compiled from a tokenizer file's vocabulary, merges and added tokens."""

    def __init__(self, vocabulary: dict[str, int], merges: list, added: list[tuple[str, int]], differ: dict[int, str] | None = None):
        self.differ = differ or {}
        symbol = byte_symbols()
        self.label = {i: bytes(symbol[c] for c in t) for t, i in vocabulary.items() if all(c in symbol for c in t)}
        self.birth = {vocabulary[s]: -1 for s in symbol if s in vocabulary}
        self.part: dict[int, tuple[int, int]] = {}
        self.removed: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if c in self.birth or a not in self.birth or b not in self.birth:
                raise ValueError(f"merge {rank} does not make a new token of two earlier ones")
            self.removed[a, b] = rank
            self.part[c] = (a, b)
            self.birth[c] = rank
        self.added = dict(added)
        for text, i in added:
            self.label[i] = text.encode()
        self.moves: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for i in self.birth:
            node = 0
            for byte in self.label[i]:
                if byte not in self.moves[node]:
                    self.moves[node][byte] = len(self.moves)
                    self.moves.append({})
                    self.ends.append(-1)
                node = self.moves[node][byte]
            self.ends[node] = i
        self.arcs: dict[int, bool] = {}  # u << 32 | v -> whether v may follow u
        self.starts: dict[bytes, list[tuple[int, int]]] = {}
        self.longest = max(map(len, self.label.values()))

    def _chain(self, token: int, side: int) -> list[int]:
        out = [token]
        while out[-1] in self.part:
            out.append(self.part[out[-1]][side])
        return out

    def arc(self, u: int, v: int) -> bool:
        """Whether ``v`` may follow ``u``."""
        known = self.arcs.get(u << 32 | v)
        if known is None:
            if len(self.arcs) >= TABLED_ARCS:
                self.arcs.clear()
            known = self.arcs[u << 32 | v] = self._replay(self._chain(u, 1), self._chain(v, 0))
        return known

    def _replay(self, us: list[int], vs: list[int]) -> bool:
        never = len(self.removed)
        while True:
            next_u = self.birth[us[-2]] if len(us) > 1 else never
            next_v = self.birth[vs[-2]] if len(vs) > 1 else never
            # A merge of a token with itself copies outgoing arcs before it
            # removes its arc, incoming ones after.
            rank = self.removed.get((us[-1], vs[-1]))
            if rank is not None and rank < next_u and rank <= next_v:
                return False
            if next_u == never and next_v == never:
                return True
            (us if next_u <= next_v else vs).pop()

    def _starting(self, rest: bytes) -> list[tuple[int, int]]:
        """``(token, length)`` of the tokens that ``rest`` starts with, longest first."""
        node, out, moves, ends = 0, [], self.moves, self.ends
        for size, byte in enumerate(rest, 1):
            node = moves[node].get(byte)
            if node is None:
                break
            if ends[node] >= 0:
                out.append((ends[node], size))
        out.reverse()
        if len(rest) <= 16:
            if len(self.starts) >= TABLED_ARCS // 4:
                self.starts.clear()
            self.starts[rest] = out
        return out

    def encode_word(self, word: bytes) -> list[int]:
        path, sizes, pos, u, dead = [], [], 0, -1, set()
        arcs, starts, longest = self.arcs, self.starts, self.longest
        while pos < len(word):
            rest = word[pos:pos + longest]
            for v, size in starts.get(rest) or self._starting(rest):
                if pos + size in dead:
                    continue
                if u >= 0:
                    known = arcs.get(u << 32 | v)
                    if not (self.arc(u, v) if known is None else known):
                        continue
                path.append(v)
                sizes.append(size)
                pos += size
                u = v
                break
            else:
                if not path:
                    raise ValueError("the vocabulary lacks a byte of this word")
                dead.add(pos)
                path.pop()
                pos -= sizes.pop()
                u = path[-1] if path else -1
        return path


class Encoder(dict):
    """Words -> ids as little-endian bytes; missing words are encoded on demand."""

    def __init__(self, automaton: TokenAutomaton):
        import regex

        super().__init__()
        self.automaton = automaton
        self.pattern, self.latin = regex.compile(WORD_PATTERN), re.compile(LATIN_PATTERN)
        self.beyond = re.compile("[^\x00-\u024f]")
        self.differ = re.compile(f"[{ranges(automaton.differ)}]") if automaton.differ else None
        self.held = 0
        added = sorted(automaton.added, key=len, reverse=True)
        self.apart = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def __missing__(self, word: str) -> bytes:
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        ids = np.array(self.automaton.encode_word(word.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        if len(word) < 64:
            self[word] = ids
            self.held += 2 * len(word) + len(ids) + ENTRY_BYTES
        return ids

    def _plain(self, text: str) -> bytes:
        pattern = self.pattern if self.beyond.search(text) else self.latin
        if pattern is self.pattern and self.differ and self.differ.search(text):
            shown = text.translate(self.automaton.differ)  # code point for code point
            return b"".join(self[text[m.start():m.end()]] for m in pattern.finditer(shown))
        if len(text) < LONG_TEXT:
            return b"".join(map(self.__getitem__, pattern.findall(text)))
        words, out = (m.group() for m in pattern.finditer(text)), []
        while some := list(islice(words, 1 << 16)):
            out.append(b"".join(map(self.__getitem__, some)))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if self.apart is None or not self.apart.search(text):
            return self._plain(text)
        return b"".join(
            np.array([self.automaton.added[piece]], "<u4").tobytes() if k % 2 else self._plain(piece)
            for k, piece in enumerate(self.apart.split(text)))

class Decoder:
    """Ids -> text: the byte labels of the ids, gathered by numpy."""

    def __init__(self, automaton: TokenAutomaton):
        top = max(automaton.label) + 1
        labels = [automaton.label.get(i, b"") for i in range(top)]
        self.size = np.array([len(x) for x in labels], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(labels), np.uint8)

    def decode(self, ids: bytes) -> str:
        every, out = np.frombuffer(ids, "<u4"), []
        for lo in range(0, len(every), DECODED_IDS):
            some = every[lo:lo + DECODED_IDS]
            size = self.size[some]
            ends = np.cumsum(size)
            shift = np.repeat(self.begin[some] - ends + size, size)
            out.append(self.flat[shift + np.arange(len(shift))].tobytes())
        return b"".join(out).decode("utf-8", "replace")


def compile_automaton(tokenizer_file: str) -> TokenAutomaton:
    """From a tokenizers JSON file that only the driver reads."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
        raise ValueError("only plain byte-level BPE files are supported")
    from tokenizers import Tokenizer

    differ = stand_ins(Tokenizer.from_file(tokenizer_file).pre_tokenizer)
    return TokenAutomaton(model["vocab"], model["merges"], [(t["content"], t["id"]) for t in spec["added_tokens"]], differ)


def _coder(shared, decode):
    automaton = shared.value
    encoder, decoder = Encoder(automaton), Decoder(automaton)

    def run(batch):
        texts = batch.column("text").to_pylist()
        ids = [encoder.encode(t or "") for t in texts]
        return [ids, [decoder.decode(i) for i in ids]] if decode else [ids]

    return run


def _decoder(shared):
    decoder = Decoder(shared.value)
    return lambda batch: [[decoder.decode(i or b"") for i in batch.column("ids").to_pylist()]]


_decoder.reads = ("ids",)


def encode(documents: DataFrame, tokenizer_file: str, keep: list[str] | None = None, decode: bool = False) -> DataFrame:
    """``keep`` columns (default: all) plus ``ids`` (binary, little-endian
    unsigned 32-bit) and, with ``decode``, ``decoded`` (text of the ids)."""
    automaton = Shared(documents.sparkSession, compile_automaton(tokenizer_file))
    fields = "ids binary, decoded string" if decode else "ids binary"
    return map_texts(documents, documents.columns if keep is None else keep, fields, _coder, (automaton, decode))


def decode(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """Adds ``decoded`` to rows that hold ``ids`` (and ``text``, for batching)."""
    automaton = Shared(encoded.sparkSession, compile_automaton(tokenizer_file))
    return map_texts(encoded, encoded.columns, "decoded string", _decoder, (automaton,))
