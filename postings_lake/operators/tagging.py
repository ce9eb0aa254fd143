"""Tagging by large taxonomies: texts' token n-grams joined to an alias table.

:func:`postings_lake.functions.lexicon.skills` spends one expression on every
taxonomy entry, which suits dozens. Here a text is cut into tokens once (runs of
word characters, and every other character alone), its n-grams of the lengths that
aliases have are looked up in a table of aliases, and the plan has the same size
whatever the taxonomy's.

An alias matches where its folded text stands between word boundaries, exactly as
:func:`lexicon.boundary_pattern` matches it: an alias that begins or ends with a word
character meets whole runs only, one that begins or ends with another character must not
touch a word character there. Aliases whose ``?`` makes the character before it
optional stand for both spellings; other regex fragments are refused.
"""
from __future__ import annotations

import functools
import itertools
import re
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings_lake.functions.lexicon import SKILL_WORD_CLASS

TOKEN = f"[{SKILL_WORD_CLASS}]+|[^{SKILL_WORD_CLASS}]"
_FRAGMENT = set("\\.^$|*+()[]{}")


@functools.cache
def _folding() -> tuple[str, str]:
    """Code points whose lower case alone does not say what they match under Unicode
    case-insensitive matching, and the lower-case letter each stands for."""
    special = {"İ": "i"}  # its own lower case has two code points
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        up = c.upper()
        if len(up) == 1 and len(up.lower()) == 1 and up.lower() != c.lower():
            special[c] = up.lower()
    return "".join(special), "".join(special.values())


def folded(text: Column) -> Column:
    """``text`` in the form in which equal means equal without regard to case."""
    src, dst = _folding()
    return F.translate(F.lower(F.translate(text, src, dst)), "ς", "σ")


def spellings(alias: str) -> list[str]:
    """The literal texts that an alias stands for."""
    if "?" not in alias:
        return [alias]
    if set(alias) & _FRAGMENT or re.search(r"^\?|\?\?", alias):
        raise ValueError(f"alias {alias!r} is a pattern; only a character made optional by '?' is supported")
    parts = re.findall(r"(.)(\?)?", alias, re.DOTALL)
    return ["".join(p) for p in itertools.product(*[(c, "") if optional else (c,) for c, optional in parts])]


def alias_table(spark: SparkSession, taxonomy: Mapping[str, Sequence[str]]) -> DataFrame:
    """``name, alias`` of a taxonomy.

    Handed over as Arrow it is a relation of known size, so the planner can broadcast it
    to the n-grams; rows of Python objects have none, and every n-gram of
    every text would be shuffled to meet them.
    """
    import pyarrow as pa

    rows = [(name, s) for name, aliases in taxonomy.items() for a in aliases for s in spellings(a)]
    names, texts = zip(*rows)
    return spark.createDataFrame(pa.table({"name": pa.array(names, pa.string()), "alias": pa.array(texts, pa.string())}))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def ngrams(tokens: Column, is_word: Column, lengths: Sequence[int]) -> Column:
    """Distinct n-grams that stand between word boundaries, as text."""
    n = F.size(tokens)

    def grams(size: int) -> Column:
        def at(i: Column) -> Column:
            left = F.get(is_word, i) | (i == 0) | ~F.get(is_word, i - 1)
            right = F.get(is_word, i + (size - 1)) | (i + size == n) | ~F.get(is_word, i + size)
            return F.when(left & right, F.concat(*[F.get(tokens, i + k) for k in range(size)]))
        return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), at)).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[grams(k) for k in lengths]))


def tag(df: DataFrame, keys: Sequence[str], text: Column, aliases: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``keys`` and ``tags`` (sorted unique names) of the rows with any.

    ``aliases`` holds ``name, alias``; ``lengths`` are the numbers of tokens that its
    aliases have. The join carries no hint: the planner broadcasts a table below its size
    threshold and shuffles by n-gram beyond. ``keys`` identify a row. Grouping by them needs no exchange where the rows are
    partitioned by them already, as after a dedupe.
    """
    table = aliases.select("name", folded(F.col("alias")).alias("gram")).where(F.col("gram") != "").distinct()
    cut = df.select(*keys, _tokens(folded(text)).alias("t"))
    cut = cut.select(*keys, "t", F.transform("t", lambda t: t.rlike(f"^[{SKILL_WORD_CLASS}]")).alias("w"))
    grams = cut.select(*keys, F.explode(ngrams(F.col("t"), F.col("w"), lengths)).alias("gram")).where(F.col("gram").isNotNull())
    return grams.join(table, "gram").groupBy(*keys).agg(F.array_sort(F.collect_set("name")).alias("tags"))


def with_tags(df: DataFrame, keys: Sequence[str], text: Column, taxonomy: Mapping[str, Sequence[str]], *,
              into: str = "skills") -> DataFrame:
    """``df`` with the names of ``taxonomy`` found in ``text``: the value that
    :func:`lexicon.skills` gives, for a taxonomy of any size.

    ``keys`` identify a row (none may be null).
    """
    spark = df.sparkSession
    texts = [s for aliases in taxonomy.values() for a in aliases for s in spellings(a)]
    none = F.array().cast("array<string>")
    if not texts:
        return df.withColumn(into, none)
    lengths = sorted(_token_counts(texts))
    found = tag(df, keys, text, alias_table(spark, taxonomy), lengths)
    return df.join(found.withColumnRenamed("tags", into), list(keys), "left").withColumn(into, F.coalesce(into, none))


def _token_counts(texts: Sequence[str]) -> set[int]:
    """Numbers of tokens, at most; letters and numbers as Python knows them, and one more
    or fewer where the JVM's tables may differ."""
    out = set()
    for t in texts:
        word = [c == "_" or c.isalnum() for c in t]
        exact = sum(1 for i, w in enumerate(word) if not w or i == 0 or not word[i - 1])
        out |= {exact} if t.isascii() else set(range(1, len(t) + 1))
    return out
