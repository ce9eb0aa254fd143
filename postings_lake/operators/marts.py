"""Aggregate marts over the curated table, declared as specs.

A :class:`MartSpec` says which rows count (``where``), which array column is
unnested into one row per element (``explode``), the group keys and the name
of the count column. :func:`build_mart` turns one spec into a DataFrame;
:func:`build_marts` computes several specs from **one** scan and **one**
shuffle of the curated table (see there).
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MartSpec:
    name: str
    keys: tuple[str, ...]
    measure: str
    where: str | None = None  # SQL predicate on curated columns, applied before the unnest
    explode: tuple[str, str] | None = None  # (array column, element alias)
    order: str = "count"  # "count", "key_then_count" (first key, then count) or "key"

    def not_null(self) -> tuple[str, ...]:
        """Group keys that must be present: the unnested element, or the only key."""
        if self.explode is not None:
            return (self.explode[1],)
        return self.keys if len(self.keys) == 1 else ()

    def ordering(self) -> list[Column]:
        """Sort of the finished mart. Keys sort ascending with nulls first, the
        count descending; the keys not used before are appended so the order
        is total (the group keys are unique in a mart)."""
        asc = [F.col(k).asc_nulls_first() for k in self.keys]
        if self.order == "key":
            return asc
        if self.order == "key_then_count":
            return asc[:1] + [F.col(self.measure).desc()] + asc[1:]
        if self.order == "count":
            return [F.col(self.measure).desc()] + asc
        raise ValueError(f"unknown mart order {self.order!r}")


# FIXED VALUES: the five marts (names, keys, filters, count column names).
SKILLS_BY_COUNTRY = MartSpec(
    "skills_by_country", ("country_code", "skill"), "mentions",
    explode=("skills", "skill"), order="key_then_count",
)
TOP_TOOLS = MartSpec(
    "top_tools", ("skill",), "junior_mentions",
    where="seniority = 'junior'", explode=("skills", "skill"),
)
CLOUD_DEMAND = MartSpec(
    "cloud_demand", ("country_code", "cloud"), "mentions",
    explode=("clouds", "cloud"), order="key_then_count",
)
JOBS_BY_DAY = MartSpec("jobs_by_day", ("posted_date",), "jobs_posted", order="key")
TOP_COMPANIES = MartSpec("top_companies", ("company",), "openings")

MARTS: tuple[MartSpec, ...] = (SKILLS_BY_COUNTRY, TOP_TOOLS, CLOUD_DEMAND, JOBS_BY_DAY, TOP_COMPANIES)
MARTS_BY_NAME = {m.name: m for m in MARTS}

_PLACE_BITS = 32  # of a record's number: its place in the unnested array


def _rows(curated: DataFrame, spec: MartSpec) -> DataFrame:
    """Input rows of one mart: filtered, unnested, null keys dropped."""
    df = curated if spec.where is None else curated.where(spec.where)
    if spec.explode is not None:
        arr, alias = spec.explode
        others = [k for k in spec.keys if k != alias]
        # explode_outer + the not-null filter below drop the same rows as a
        # plain explode, but a plain explode makes Catalyst infer
        # ``size(arr) > 0`` and push it below the projection that computes
        # ``arr``, evaluating the (regex-heavy) array expression twice.
        df = df.select(*others, F.explode_outer(arr).alias(alias))
    else:
        df = df.select(*spec.keys)
    for k in spec.not_null():
        df = df.where(F.col(k).isNotNull())
    return df


def order_mart(df: DataFrame, spec: MartSpec) -> DataFrame:
    return df.orderBy(*spec.ordering())


def build_mart(curated: DataFrame, spec: MartSpec, *, ordered: bool = True) -> DataFrame:
    """One mart: ``count(*)`` per key over the spec's rows.

    Plans as partial hash aggregate -> exchange on the keys -> final
    aggregate; the map-side partial count means a key holding a third of the
    rows sends one row per map task through the shuffle.
    """
    out = _rows(curated, spec).groupBy(*spec.keys).agg(F.count(F.lit(1)).alias(spec.measure))
    return order_mart(out, spec) if ordered else out


def _tagged_union_schema(specs: Sequence[MartSpec], curated: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of every distinct key column across the specs."""
    types: dict[str, str] = {}
    for s in specs:
        for k in s.keys:
            if s.explode is not None and k == s.explode[1]:
                t = curated.schema[s.explode[0]].dataType.elementType.simpleString()
            else:
                t = curated.schema[k].dataType.simpleString()
            if types.setdefault(k, t) != t:
                raise ValueError(f"mart key {k!r} is {types[k]} in one mart and {t} in {s.name!r}")
    return list(types.items())


def build_marts(curated: DataFrame, specs: Sequence[MartSpec] = MARTS) -> dict[str, DataFrame]:
    """Several marts from one pass over ``curated`` (see :func:`tagged_counts`).

    The shared aggregate is small (one row per mart row); each mart is a filter of
    it. Callers that write several marts should persist ``result["__all__"]``.
    """
    agg = tagged_counts(curated, specs)
    return {"__all__": agg, **{s.name: mart_of(agg, specs, s) for s in specs}}


def mart_of(counts: DataFrame, specs: Sequence[MartSpec], spec: MartSpec) -> DataFrame:
    """One finished mart of the tagged counts of ``specs``."""
    mine = counts.where(F.col("__mart") == list(specs).index(spec))
    return order_mart(mine.select(*spec.keys, F.col("__n").alias(spec.measure)), spec)


def tagged_counts(curated: DataFrame, specs: Sequence[MartSpec] = MARTS, weight: str | None = None) -> DataFrame:
    """``__mart`` (position in ``specs``), every key column, and the count ``__n`` of
    all marts; with ``weight``, the sum of that column of the rows instead.

    Every curated row emits one number per mart row it feeds: the spec's position in the
    upper half, the place in the unnested array in the lower. The numbers of all
    specs are concatenated and unnested once, and the keys are read by number
    beside the row. A single ``groupBy(tag, keys...)`` with a map-side partial count then
    produces all marts at once, so silver is scanned once and shuffled once. All of it is
    built from expressions with generated code (no higher-order functions), and that
    code stays small: records of every key, built for every spec in one expression, made a method
    beyond the size that the JVM compiles, which ran interpreted.
    """
    cols = _tagged_union_schema(specs, curated)
    names = [c for c, _ in cols]
    none = F.array().cast("array<bigint>")
    numbers: list[Column] = []
    for i, s in enumerate(specs):
        first = F.lit(i << _PLACE_BITS).cast("long")
        if s.explode is not None:
            n = F.coalesce(F.size(F.col(s.explode[0])), F.lit(0))  # size(null) is -1 without ANSI
            recs, cond = F.sequence(first, first + n - 1), n > 0
        else:
            recs, cond = F.array(first), F.lit(True)
            for k in s.not_null():
                cond = cond & F.col(k).isNotNull()
        if s.where is not None:
            cond = F.expr(s.where) & cond
        # A null condition contributes no records but must not null out the
        # concatenation of the other marts' records.
        numbers.append(F.coalesce(F.when(cond, recs), none))
    # explode_outer for the reason given in _rows; its null padding rows are dropped.
    by = [] if weight is None else [F.col(weight).alias("__weight")]
    read = {s.explode[0] for s in specs if s.explode is not None} | {k for s in specs for k in s.keys if s.explode is None or k != s.explode[1]}
    sources = {c: f"__of_{c}" for c in curated.columns if c in read}
    rows = curated.select(*by, *[F.col(c).alias(a) for c, a in sources.items()], F.explode_outer(F.concat(*numbers)).alias("__number"))
    mart = F.shiftright("__number", _PLACE_BITS).cast("int")
    place = F.col("__number").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")

    def key(c: str, t: str) -> Column:
        plain = [i for i, s in enumerate(specs) if c in s.keys and (s.explode is None or c != s.explode[1])]
        out = F.when(mart.isin(plain), F.col(sources[c]).cast(t)) if plain else None
        for i, s in enumerate(specs):
            if s.explode is not None and c == s.explode[1] and c in s.keys:
                item = F.get(F.col(sources[s.explode[0]]), place).cast(t)
                out = F.when(mart == i, item) if out is None else out.when(mart == i, item)
        return out

    tagged = rows.where(F.col("__number").isNotNull()).select(
        *[F.col("__weight") for _ in by], mart.alias("__mart"), *[key(c, t).alias(c) for c, t in cols])
    for i, s in enumerate(specs):
        if s.explode is not None:  # null elements of the unnested array feed no mart row
            tagged = tagged.where((F.col("__mart") != i) | F.col(s.explode[1]).isNotNull())
    total = F.count(F.lit(1)) if weight is None else F.sum("__weight")
    return tagged.groupBy("__mart", *names).agg(total.alias("__n"))


def updated_counts(counts: DataFrame, signed: DataFrame, specs: Sequence[MartSpec] = MARTS, weight: str = "weight") -> DataFrame:
    """Stored mart counts (the shape of :func:`tagged_counts`) brought up to date with
    signed curated rows: a row that entered counts 1, one that left -1.

    The work follows the signed rows and the marts, not the curated table. Mart rows
    that nothing counts for any more go.
    """
    keys = [c for c in counts.columns if c != "__n"]
    every = counts.unionByName(tagged_counts(signed, specs, weight).select(*keys, F.col("__n").cast("long").alias("__n")))
    return every.groupBy(*keys).agg(F.sum("__n").alias("__n")).where(F.col("__n") != 0)


def named_marts(counts: DataFrame, specs: Sequence[MartSpec] = MARTS) -> DataFrame:
    """Tagged counts as one table: ``mart``, the key columns and the count ``n``."""
    names = F.array(*[F.lit(s.name) for s in specs])
    keys = [c for c in counts.columns if not c.startswith("__")]
    return counts.select(F.get(names, F.col("__mart")).alias("mart"), *keys, F.col("__n").alias("n"))


def gold_all(curated: DataFrame, specs: Sequence[MartSpec] = MARTS) -> DataFrame:
    """All marts in one table: ``mart``, every key column (null where a mart
    lacks it) and the count ``n``; one scan and one shuffle."""
    return named_marts(tagged_counts(curated, specs), specs)


def mart_previews(curated: DataFrame, rows: int, specs: Sequence[MartSpec] = MARTS) -> DataFrame:
    """The first ``rows`` rows of every mart in its own order, with the mart's
    row count beside each: ``mart, position, key_1, key_2, ..., n, mart_rows``.

    Keys come as text, in the order of the mart's spec. Each task keeps its own
    first rows of a mart before they meet; the counts are summed map-side.
    """
    every, width = gold_all(curated, specs), max(len(s.keys) for s in specs)

    def by_mart(value) -> Column:
        out = None
        for s in specs:
            out = (out.when if out is not None else F.when)(F.col("mart") == s.name, value(s))
        return out

    def key(s: MartSpec, i: int) -> Column:
        return F.col(s.keys[i]).cast("string") if i < len(s.keys) else F.lit(None).cast("string")

    named = every.select("mart", "n", *[by_mart(lambda s, i=i: key(s, i)).alias(f"key_{i + 1}") for i in range(width)])
    most_first = by_mart(lambda s: F.lit(0) if s.order == "key" else -F.col("n"))
    first_key = F.when(F.col("mart").isin([s.name for s in specs if s.order == "key_then_count"]), F.col("key_1"))
    order = [first_key.asc_nulls_first(), most_first.asc(), *[F.col(f"key_{i + 1}").asc_nulls_first() for i in range(width)]]
    top = named.withColumn("position", F.row_number().over(Window.partitionBy("mart").orderBy(*order))).where(F.col("position") <= rows)
    # Reads ``n``, which is never 0, so that both branches need the same columns and
    # share one aggregate (its exchange is reused).
    sizes = named.groupBy("mart").agg(F.count_if(F.col("n") != 0).alias("mart_rows"))
    return top.join(sizes, "mart").select("mart", "position", *[f"key_{i + 1}" for i in range(width)], "n", "mart_rows")
