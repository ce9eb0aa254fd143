"""Simple-8b words, files of token ids, and fill-in-the-middle cuts."""
from __future__ import annotations

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postings_lake.llm import fillmiddle, tokenfiles

R = random.Random(12)


# --- Simple-8b -----------------------------------------------------------------------

def cases():
    rng = np.random.default_rng(0)
    yield np.zeros(0, np.uint64)
    yield np.zeros(tokenfiles.BLOCK + 1, np.uint64)
    yield np.array([2**64 - 1] * 5 + [0, 1] + [2**60, 2**60 - 1], np.uint64)
    for high in (2, 300, 50_000, 1 << 33, 1 << 60, 1 << 62):
        for n in (1, 59, tokenfiles.BLOCK, 3 * tokenfiles.BLOCK + 17):
            ids = rng.integers(0, high, n, dtype=np.uint64)
            ids[rng.random(n) < 0.6] = 1
            ids[rng.random(n) < 0.01] = np.uint64(2**64 - 1)  # looks like any selector
            yield ids


@pytest.mark.parametrize("at_once", [1, 64])
def test_words_give_the_ids_back(monkeypatch, at_once):
    monkeypatch.setattr(tokenfiles, "AT_ONCE", at_once)
    for ids in cases():
        words, firsts = tokenfiles.pack(ids)
        assert (tokenfiles.unpack(words, firsts, len(ids)) == ids).all()
        assert len(firsts) == -(-len(ids) // tokenfiles.BLOCK)
        for b in range(len(firsts)):  # any block alone
            one = tokenfiles.unpack(words, firsts, len(ids), b, b + 1)
            assert (one == ids[b * tokenfiles.BLOCK:(b + 1) * tokenfiles.BLOCK]).all()


def test_each_word_takes_the_largest_count_that_fits():
    ids = np.array(R.choices([0, 1, 5, 90, 4000, 49_000, 1 << 25, 1 << 40], k=3000), np.uint64)
    want, at = [], 0
    while at < len(ids):
        for s, (count, width) in enumerate(tokenfiles.PACKINGS, 1):
            some = [int(i) for i in ids[at:at + count]]
            if max(some) < 1 << width:
                want.append(s << 60 | sum(v << width * k for k, v in enumerate(some)))
                at += count
                break
    assert tokenfiles.pack(ids)[0].tolist() == want


def test_selectors_are_found_for_all_places_at_once():
    """Also where the ids end, and those of more than 60 bits."""
    ids = np.array(R.choices([0, 1, 5, 90, 4000, 49_000, 1 << 25, 1 << 40, 1 << 61], [60, 60, 9, 9, 9, 9, 1, 1, 1], k=2000), np.uint64)
    want = [next((s for s, (count, width) in enumerate(tokenfiles.PACKINGS, 1) if max(map(int, ids[at:at + count])) < 1 << width), 0)
            for at in range(len(ids))]
    assert tokenfiles._selectors(tokenfiles.bit_lengths(ids)).tolist() == want and 0 in want and 1 in want


def test_bit_lengths():
    ids = [0, 1, 2, 3, 49_000, 2**16 - 1]
    for some in (ids, [*ids, 2**16, 2**53 - 1, 2**53, 2**63, 2**64 - 1], []):
        assert tokenfiles.bit_lengths(np.array(some, np.uint64)).tolist() == [i.bit_length() for i in some]


def test_records_parse_and_refuse_other_bytes():
    ids = np.array(R.choices(range(50_000), k=10_000), np.uint64)
    raw = tokenfiles.to_record(3, 1, [None, 4, 9], [5000, 0, 5000], ids) + b"\n"
    r = tokenfiles.Record(raw)
    assert (r.partition, r.number, r.unnamed, r.docs.tolist(), r.ends.tolist()) == (3, 1, 1, [0, 4, 9], [5000, 5000, 10_000])
    assert (r.ids() == ids).all() and (r.ids(4090, 4100) == ids[4090:4100]).all() and len(r.ids(7, 7)) == 0
    for broken in (raw[:-1], raw[:-9] + b"\n", b"x" + raw):
        with pytest.raises(ValueError):
            tokenfiles.Record(broken)


# --- files ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer_file():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(tokenizer_file):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


ODD = "á éX ́ Å Σςσ İI ﬁ ำ 가 Ⅷ \x1c\x85\xa0  \U0001f600 <|endoftext|> it's IT'S 'Sx !'s 12\xb2 \xaa\xdf".split(" ")


def odd_text(n):
    return "".join(R.choice([*ODD, "word", "Été", " ", "\n", "\t", "\r", "  ", chr(R.randrange(1, 0x500))]) for _ in range(n))


def test_pieces_equal_the_library_on_whole_texts(tokenizer_file, library):
    with open(tokenizer_file, encoding="utf-8") as f:
        known = tokenfiles.WordIds(f.read())
    texts = ["", " ", "a", *[odd_text(R.randrange(60)) for _ in range(4000)],
             *["x" + chr(c) + "1 " + chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]]
    got = [np.frombuffer(ids, "<u4").tolist() for k in range(0, len(texts), 999) for ids in known.encode(texts[k:k + 999])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_plain_texts_are_cut_at_once(tokenizer_file, library):
    with open(tokenizer_file, encoding="utf-8") as f:
        known = tokenfiles.WordIds(f.read())
    pool = [*"abstTrevmldD09'.,\n\t\r Éł<>|", "'LL", "'re", "'", " ", "Straße", "<|ENDOFTEXT|>"]
    plain = ["".join(R.choices(pool, k=R.randint(0, 60))) for _ in range(400)]
    odd = [t + R.choice(["<|endoftext|>", " Σσς", "\x0b", "中"]) for t in plain[:200]]
    coded = known.encode(plain)
    assert list(known.words) == [""]  # each piece once, whatever its case and what stands beside it
    assert [np.frombuffer(c, "<u4").tolist() for c in coded + known.encode(odd + plain)] == [
        library.encode(t, add_special_tokens=False).ids for t in plain + odd + plain]


def test_plain_texts_are_cut_as_bytes_all_at_once(tokenizer_file, library, monkeypatch):
    """No text is put to the pattern; the pieces are those that it finds."""
    pool = [*"abstrevmldz09'.,!\n\t\r éß<>|", "'ll", "'re", "'ve", "'"]
    texts = ["".join(R.choices(pool, k=R.randint(0, 12))) for _ in range(4000)]
    for k in range(0, len(texts), 7):
        some = texts[k:k + R.randint(0, 7)]
        data, at, first = tokenfiles.cut_plain([t.encode() for t in some])
        edges, want = [*at.tolist(), len(data)], [tokenfiles.WORDS.findall(t) for t in some]
        assert [bytes(data[a:b]).decode() for a, b in zip(edges, edges[1:])] == [p for pieces in want for p in pieces]
        assert first.tolist() == np.cumsum([0, *map(len, want)]).tolist()
    monkeypatch.setattr(tokenfiles, "WORDS", None)
    with open(tokenizer_file, encoding="utf-8") as f:
        known = tokenfiles.WordIds(f.read())
    mixed = texts + [t.upper() for t in texts if "ß" not in t]
    assert known.encode([" ", "\n"]) == [b"", b""] and known.encode([]) == []
    assert [np.frombuffer(c, "<u4").tolist() for c in known.encode(mixed)] == [e.ids for e in library.encode_batch(mixed, add_special_tokens=False)]


def test_pieces_pass_through_normal_forms_that_change_them(tokenizer_file):
    from tokenizers import Tokenizer

    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"]["normalizers"] = [{"type": "NFD"}, {"type": "StripAccents"}, *spec["normalizer"]["normalizers"][1:]]
    texts = ["Été à la plage", "deja", "déjà it's"]
    library = Tokenizer.from_str(json.dumps(spec))
    assert [np.frombuffer(c, "<u4").tolist() for c in tokenfiles.WordIds(json.dumps(spec)).encode(texts)] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_forgotten_and_learnt_again(tokenizer_file, monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHE_BYTES", 500)
    with open(tokenizer_file, encoding="utf-8") as f:
        known = tokenfiles.WordIds(f.read())
    first = known.encode(["alpha beta gamma"])
    assert known.encode(["delta"]) and "alpha" not in known.words and "alpha" not in known.pieces
    assert known.encode(["alpha beta gamma", ""]) == [first[0], b""]


def expected(library, rows):
    """Brute force over (doc_id, text); rows of one id in any order."""
    out, at = [], 0
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [50, 4_000_000])
def test_files_hold_all_documents_in_order(spark, workdir, tokenizer_file, library, monkeypatch, file_ids):
    monkeypatch.setattr(tokenfiles, "PARTITION_BYTES", 1500)
    monkeypatch.setattr(tokenfiles, "FILES_SUMMED", 3)
    rows = [(i * 7 - 100, odd_text(R.randrange(40))) for i in range(150)] + [(None, "no id"), (10**12, None), (10**12 + 1, "")]
    rows.append((10**13, "long " * 5000))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("start", F.lit(1))
    path = f"{workdir}/files"
    got = tokenfiles.round_trip(df.repartition(5), tokenizer_file, 1, path, file_ids).collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(library, rows)
    back = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in tokenfiles.read(spark, path).collect()}
    assert back[10**13] == library.encode("long " * 5000, add_special_tokens=False).ids + [1]
    if file_ids == 50:
        assert spark.read.format("binaryFile").load(path).count() > 20


def test_repeated_documents_have_their_own_places(spark, tokenizer_file, library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "PARTITION_BYTES", 400)  # many partitions, so one id spans several
    rows = [(5, "the same text")] * 40 + [(5, "another")] * 3 + [(4, "before"), (6, None), (6, None)]
    got = tokenfiles.round_trip(spark.createDataFrame(rows, "doc_id int, text string").repartition(3), tokenizer_file, 1).collect()
    n = {t: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows}
    by_start = sorted(map(tuple, got), key=lambda r: r[1])
    assert [r[0] for r in by_start] == [4] + [5] * 43 + [6] * 2
    assert [r[1] for r in by_start] == [0, *np.cumsum([r[2] for r in by_start])[:-1].tolist()]
    assert sorted(r[2] for r in by_start if r[0] == 5) == sorted([n["the same text"]] * 40 + [n["another"]] * 3)


def test_no_documents(spark, tokenizer_file):
    assert tokenfiles.round_trip(spark.createDataFrame([], "doc_id long, text string"), tokenizer_file, 1).collect() == []


# --- fill in the middle -----------------------------------------------------------------

def plain_cut(doc, text, unit="code points"):
    """The contract, written plainly: (n, form, prefix, middle, output)."""
    text = text or ""
    units = list(text)
    if unit == "words":
        units, space = [], " \t\n\r\x0b\x0c"
        for c in text:
            if units and not (units[-1][-1] in space and c not in space):
                units[-1] += c
            else:
                units.append(c)
    d = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(d[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["code points", "words"])
@pytest.mark.parametrize("chunks", [(64, 8192, 9), (32, 40, 2)])
def test_cuts_equal_plain_slicing(spark, monkeypatch, unit, chunks):
    for name, value in zip(("LEAST", "MOST", "CHUNK_BITS"), chunks):
        monkeypatch.setattr(fillmiddle, name, value)
    shared = "".join(R.choice("ab é漢\U0001f600\n") for _ in range(700))
    texts = [odd_text(R.randrange(300)).replace("<|endoftext|>", "") for _ in range(200)] + [shared + odd_text(20) + shared for _ in range(40)]
    texts += ["", None, "<P> here", "a<M>", "<S>", "<P", " ", "漢" * 9000, "x" * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("output", F.lit("clash"))
    got = fillmiddle.transform(df.repartition(3), unit=unit).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) == plain_cut(r["doc_id"], r["text"], unit)
        assert r["restored"] == (r["text"] or "")
        if r["form"] != "plain":
            assert r["prefix_units"] + r["middle_units"] + r["suffix_units"] == r["n"]
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_shared_passages_fall_into_equal_chunks_counted_once():
    shared = bytes(R.choices(range(97, 123), k=60_000))
    texts = [bytes(R.choices(range(97, 123), k=k)) + shared for k in (10, 333, 7001)]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    counter, seen = fillmiddle.Counter("code points"), []
    for text, ends in zip(texts, fillmiddle.splits(data, at)):
        assert ends[-1] == len(text) and all(b - a <= fillmiddle.MOST for a, b in zip([0, *ends], ends))
        assert all(b - a >= fillmiddle.LEAST for a, b in zip([0, *ends], ends[:-1]))
        assert counter.measure(text, ends).units == len(text)
        seen.append(counter.found)
    assert seen[1] - seen[0] < 0.1 * seen[0] and counter.asked > 2 * counter.found


def test_a_full_store_starts_anew(monkeypatch):
    monkeypatch.setattr(fillmiddle, "CACHE_BYTES", 1000)
    counter = fillmiddle.Counter("code points")
    for k in range(50):
        assert counter[b"%04d" % k] == (0, 0, 3)
    assert len(counter) < 10


def test_rebuild_refuses_other_outputs():
    for bad in ("<P>a<S>b", "a", "<S>a<P>b<M>c"):
        with pytest.raises(ValueError):
            fillmiddle.rebuild(bad, "psm")


def test_nothing_to_cut(spark):
    assert fillmiddle.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []
