"""Secret scans in DataFrame functions only.

Three fixed patterns give the base spans: assignments of a value to a secret's
name, access keys, and long hexadecimal strings. Matches of a pattern and the
text between them come from the same pattern, so running lengths give every
match's position in code points.

The method adds spans: candidates are runs of ``CANDIDATE`` characters outside
base spans (which cut the runs they lie in). Two character Markov models (pair counts, backed off to shares of
single characters), one of random strings and one of ordinary identifiers, are trained from labelled
samples, and a candidate is a secret when the log-likelihood ratio of some stretch
of its pairs reaches ``THRESHOLD``, whatever ordinary text is joined to it. The ratios of all pairs are one table of 128 x 128 whole
numbers (thousandths), which the scan holds as a literal array.

Defined cases: a null text is empty; an empty text has no span; texts are read
whole; spans of different kinds may overlap, spans of one kind do not; repeated
rows are scanned each; without samples no span is added; columns named ``base`` and
``spans`` are replaced by the results, other extra columns stay as they are.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings_lake.llm.common import bound

# Patterns, and the least lengths of what must be long enough.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of 24 or more is a maximal run, as runs are taken whole
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
THRESHOLD = 35_000  # thousandths of a nat
BACKOFF = 8.0  # weight of a model's single-character shares in its pair shares
WALK = 128  # matches placed at a time
PIECE = 4096  # characters of a candidate scored at a time


def no_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def in_blocks(values: Column) -> Column:
    """An array's elements in arrays of ``WALK``, one (empty) at least."""
    return bound(values, lambda v: F.transform(
        F.sequence(F.lit(1), F.greatest(F.ceil(F.size(v) / WALK).cast("int"), F.lit(1))),
        lambda b: F.slice(v, (b - 1) * WALK + 1, F.lit(WALK))))


def walked(sizes: Column, start: Column, kind: int) -> Column:
    """Spans of matches, given the gap before each and its size, from ``start``."""
    begin = F.struct(start.alias("at"), no_spans().alias("spans"))
    return F.aggregate(sizes, begin, lambda acc, m: F.struct(
        (acc["at"] + m["gap"] + m["size"]).alias("at"),
        F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + m["gap"]).alias("start"), F.lit(kind).alias("kind"),
            (acc["at"] + m["gap"] + m["size"]).alias("end")))).alias("spans")))["spans"]


def placed(sizes: Column, kind: int) -> Column:
    """``walked`` over all matches, in blocks of ``WALK``: each step copies the
    spans of its block only, so the work does not grow with the square."""
    def by_block(parts):
        total = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda acc, m: acc + m["gap"] + m["size"]))
        begin = F.aggregate(total, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.zip_with(parts, F.slice(begin, F.lit(1), F.size(parts)), lambda p, at: walked(p, at, kind)))

    return bound(in_blocks(sizes), by_block)


def located(text: Column, pattern: str, kind: int, keep=None, group: int = 0) -> Column:
    """Spans of a pattern's matches; ``keep`` is a condition on the text of a
    match's ``group``."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    between = F.transform(F.split(text, pattern, -1), F.length)
    sizes = bound(found, lambda size: F.zip_with(
        size, F.slice(between, F.lit(1), F.size(size)), lambda size, gap: F.struct(gap.alias("gap"), size.alias("size"))))
    spans = placed(sizes, kind)
    if keep is not None:
        kept = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), keep)
        spans = F.filter(F.zip_with(spans, kept, lambda span, yes: F.when(yes, span)), lambda span: span.isNotNull())
    return F.when(text.rlike(pattern), spans).otherwise(no_spans())


def base_spans(text: Column) -> Column:
    assign = located(text, ASSIGN, 0, lambda value: F.length(value) >= LEAST_VALUE, group=2)
    access = located(text, ACCESS, 1, lambda found: F.length(found) >= LEAST_ACCESS)
    return F.array_sort(F.concat(assign, access, located(text, HEX, 2)))


def pair_codes(value: Column) -> Column:
    """Neighbouring characters of an ASCII string as numbers below 128 * 128."""
    codes = F.transform(F.split(value, ""), F.ascii)
    return F.zip_with(F.slice(codes, F.lit(1), F.greatest(F.size(codes) - 1, F.lit(0))),
                      F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: a * 128 + b)


def train(samples: DataFrame) -> list[int]:
    """Log-likelihood ratios of all pairs, in thousandths, from ``samples``
    (``value``, ``random`` boolean). At most 2 * 128 * 128 counts reach the driver."""
    pairs = samples.select("random", F.explode(pair_codes(F.col("value"))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    table = [0] * (128 * 128)
    if len({r for r, _ in counts}) < 2:
        return table
    used = sorted({p // 128 for _, p in counts} | {p % 128 for _, p in counts})
    models = {}
    for r in (True, False):
        single = {b: sum(counts.get((r, a * 128 + b), 0) for a in used) + 0.5 for b in used}
        whole = sum(single.values())
        after = {a: sum(counts.get((r, a * 128 + b), 0) for b in used) for a in used}
        models[r] = {(a, b): (counts.get((r, a * 128 + b), 0) + BACKOFF * single[b] / whole) / (after[a] + BACKOFF)
                     for a in used for b in used}
    for a, b in models[True]:
        table[a * 128 + b] = round(1000 * math.log(models[True][a, b] / models[False][a, b]))
    return table


def random_samples(spark: SparkSession, n: int = 4096) -> DataFrame:
    """Random strings of the usual alphabets, from hashes of running numbers."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    packed = F.base64(F.unhex(digest))
    return spark.range(n).select(F.explode(F.array(packed, F.translate(packed, "+/=", "-_"), F.substring(digest, 1, 40))).alias("value"),
                                 F.lit(True).alias("random"))


def rule_samples(spark: SparkSession, n: int = 2000) -> DataFrame:
    """Ordinary strings that few texts hold: rulers, dates and running numbers."""
    day = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") * 7).cast("int")).cast("string")
    rulers = [F.repeat(F.lit(c), 8) for c in "-=_/+"]
    number = (F.col("id") * 100_003).cast("string")
    return spark.range(n).select(F.explode(F.array(*rulers, F.concat(day, F.lit("-"), day), number, F.concat_ws("-", number, number))).alias("value"),
                                 F.lit(False).alias("random"))


def identifier_samples(documents: DataFrame, texts: int = 256) -> DataFrame:
    """Words of at most ``texts`` documents, chosen by the hash of ``doc_id``
    (one for each hash cell), outside base matches: as they are, in capitals, and
    joined with the next word the ways that names and paths are."""
    h = F.xxhash64(F.col("doc_id").cast("string"))
    some = documents.select("doc_id", "text").filter("doc_id is not null and text is not null").groupBy(
        F.pmod(h, F.lit(texts)).alias("cell")).agg(F.min_by("doc_id", F.struct(F.xxhash64(h), F.col("doc_id"))).alias("doc_id"))
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    chosen = documents.select("doc_id", "text").join(F.broadcast(some.select("doc_id")), "doc_id")
    words = F.regexp_extract_all(text, F.lit("[A-Za-z0-9]{3,19}"), F.lit(0))
    forms = F.zip_with(words, F.slice(words, F.lit(2), F.size(words) + 1), lambda a, b: F.array(
        a, F.upper(a), F.concat_ws("_", a, b), F.concat_ws("_", F.upper(a), F.upper(b)), F.concat_ws("-", a, b),
        F.concat_ws("/", a, b), F.concat(F.initcap(a), F.initcap(F.coalesce(b, F.lit(""))))))
    return chosen.select(F.explode(F.flatten(forms)).alias("value"), F.lit(False).alias("random"))


def fit(documents: DataFrame) -> list[int]:
    """The ratios trained from the three samples above."""
    spark = documents.sparkSession
    return train(random_samples(spark).union(rule_samples(spark)).union(identifier_samples(documents)))


def added_spans(text: Column, base: Column, table: list[int], threshold: int = THRESHOLD) -> Column:
    """Candidates outside base spans of whose stretches one reaches ``threshold``."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")

    nothing = F.lit(0).cast("long")

    def further(acc, pair):
        run = acc["run"] + F.get(ratios, pair)
        return F.struct(F.greatest(run, nothing).alias("run"), F.greatest(acc["best"], run).alias("best"))

    def random(value):
        # Long candidates go in pieces, each with the last character of the one before.
        cut = F.regexp_extract_all(value, F.lit(f".{{1,{PIECE}}}"), F.lit(0))
        joined = bound(cut, lambda ps: F.transform(ps, lambda p, i: F.concat(
            F.when(i > 0, F.right(F.get(ps, i - 1), F.lit(1))).otherwise(F.lit("")), p)))
        start = F.struct(nothing.alias("run"), nothing.alias("best"))
        return F.aggregate(joined, start, lambda acc, p: F.aggregate(pair_codes(p), acc, further))["best"] >= threshold

    def blank(at, span):
        return F.repeat(F.lit(" "), F.greatest(span["end"] - F.greatest(at, span["start"]), F.lit(0)))

    return bound(replaced(text, base, blank), lambda outside: located(outside, CANDIDATE, 3, random))


def scan(documents: DataFrame, table: list[int]) -> DataFrame:
    """``documents`` plus ``base`` and ``spans`` (all): arrays of start, kind (its
    number in ``KINDS``) and end, by start and kind."""
    text = F.coalesce("text", F.lit(""))
    found = documents.withColumn("base", base_spans(text))
    return found.withColumn("spans", F.array_sort(F.concat("base", added_spans(text, F.col("base"), table))))


def of_kind(kind: int):
    return lambda span: span["kind"] == kind


def listed(spans: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def marked(spans: Column, piece: Column, offset: Column, mark) -> Column:
    """A piece of a text, from ``offset`` on, with each of its spans as ``mark(at,
    span)``, where ``at`` is the end of the spans before."""
    start = F.struct(offset.alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.concat(acc["out"], F.substring(piece, acc["at"] - offset + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                 mark(acc["at"], s)).alias("out")))["out"]


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (or run of overlapping spans) replaced by ``mark``."""
    return replaced(text, spans, lambda at, s: F.when(s["start"] < at, "").otherwise(mark))


def replaced(text: Column, spans: Column, mark) -> Column:
    """The text with ``mark(at, span)`` in place of spans, as ``marked`` has it.

    Blocks of spans each work on their own piece of the text, which ends where
    the furthest span so far does."""
    def by_block(whole, parts):
        furthest = F.transform(parts, lambda p: F.array_max(F.transform(p, lambda s: s["end"])))
        reach = F.aggregate(furthest, F.array(F.lit(0)), lambda acc, e: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), e))))

        def block(at):
            out = F.transform(parts, lambda p, i: bound(
                F.substring(whole, F.get(at, i) + 1, F.get(at, i + 1) - F.get(at, i)),
                lambda piece: marked(p, piece, F.get(at, i), mark)))
            return F.concat(F.array_join(out, ""), F.substring(whole, F.element_at(at, -1) + 1, F.length(whole)))

        return bound(reach, block)

    return F.when(F.size(spans) == 0, text).otherwise(
        bound(text, lambda whole: bound(in_blocks(spans), lambda parts: by_block(whole, parts))))
