"""Bronze -> curated (silver): one clean, enriched row per posting."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from postings_lake.functions import dates, lexicon, text
from postings_lake.operators.newest import newest_per_key, row_digest

# FIXED VALUES: bronze column contract (name and type, in order) and the
# source name assumed when a row carries none.
BRONZE_SCHEMA = StructType(
    [
        StructField("source_name", StringType()),
        StructField("source_id", StringType()),
        StructField("title", StringType()),
        StructField("company", StringType()),
        StructField("country_code", StringType()),
        StructField("location_display", StringType()),
        StructField("region", StringType()),
        StructField("city", StringType()),
        StructField("category", StringType()),
        StructField("contract_time", StringType()),
        StructField("salary_min", DoubleType()),
        StructField("salary_max", DoubleType()),
        StructField("created", StringType()),
        StructField("description", StringType()),
        StructField("redirect_url", StringType()),
        StructField("ingested_at", StringType()),
    ]
)
DEFAULT_SOURCE = "adzuna"

# FIXED VALUES: curated column contract, in order.
SILVER_COLUMNS: tuple[str, ...] = (
    "source_name", "source_id", "title", "company", "country_code", "city", "region",
    "location_display", "category", "contract_time", "seniority",
    "posted_date", "skills", "clouds", "skill_count",
    "salary_min", "salary_max", "redirect_url", "ingested_at",
)

# A bronze row's digest, where a table stores it beside the contract's columns. It
# orders rows that share key and time, before and after curation alike.
DIGEST = "row_digest"


@dataclass(frozen=True)
class CurateSpec:
    """Parameters of the curation step.

    ``key`` identifies a posting for deduplication; it is a set, listed most
    selective column first because the first column leads the sort prefix of
    the dedupe. ``order`` picks how ``ingested_at`` is compared (see
    :func:`newest_per_key`).
    """

    key: tuple[str, ...] = ("source_id", "source_name")
    default_source: str = DEFAULT_SOURCE
    order: str = "string"
    taxonomy: Mapping[str, Sequence[str]] = field(default_factory=lambda: lexicon.SKILL_TAXONOMY)
    cloud_names: tuple[str, ...] = lexicon.CLOUD_SKILLS
    seniority_classes: tuple = lexicon.SENIORITY_CLASSES


def conform_bronze(df: DataFrame) -> DataFrame:
    """Select the bronze contract columns in order, cast to their types;
    columns the input lacks are null."""
    cols = df.columns
    return df.select(
        *[
            (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in BRONZE_SCHEMA.fields
        ]
    )


def keyed(bronze: DataFrame, spec: CurateSpec = CurateSpec()) -> DataFrame:
    """Rows that have an id, with the default source filled in.

    The default is applied before deduplication, so a row without a source and
    a row of the default source with the same id are one posting.
    """
    return bronze.where(F.col("source_id").isNotNull()).withColumn(
        "source_name", F.coalesce(F.col("source_name"), F.lit(spec.default_source))
    )


def with_digest(bronze: DataFrame) -> DataFrame:
    """Bronze contract rows with their :data:`DIGEST`."""
    return bronze.withColumn(DIGEST, row_digest([f for f in BRONZE_SCHEMA.fields if f.name in bronze.columns]))


def _stored_digest(df: DataFrame) -> str | None:
    return DIGEST if DIGEST in df.columns else None


def dedupe(bronze: DataFrame, spec: CurateSpec = CurateSpec()) -> DataFrame:
    """Newest ingested copy of every posting (null ids dropped)."""
    return newest_per_key(keyed(bronze, spec), spec.key, "ingested_at", order=spec.order, digest=_stored_digest(bronze))


def merge(silver: DataFrame, bronze: DataFrame, spec: CurateSpec = CurateSpec()) -> DataFrame:
    """``silver`` brought up to date with new bronze rows only: the newest of the
    stored rows and the curated new ones. The same result as curating the whole
    history if both hold a :data:`DIGEST`; else unless an old and a new copy of a key
    share ``ingested_at``."""
    digest = _stored_digest(silver) if DIGEST in bronze.columns else None
    columns = [*SILVER_COLUMNS, *([digest] if digest else [])]
    both = silver.select(*columns).unionByName(curate(bronze, spec).select(*columns))
    return newest_per_key(both, spec.key, "ingested_at", order=spec.order, digest=digest)


def wins(spec: CurateSpec, new: str, old: str) -> Column:
    """Whether row ``new`` takes the place of row ``old`` of its key (both aliases of
    curated rows with digests), as :func:`newest_per_key` orders them."""
    def order(alias: str) -> Column:
        at = F.col(f"{alias}.ingested_at")
        newest = [F.try_to_timestamp(at), at] if spec.order == "timestamp" else [at]
        # Nulls come last: a value beats none.
        return F.struct(*[c for v in newest for c in (v.isNotNull(), v)])
    n, o = order(new), order(old)
    return (n > o) | ((n == o) & (F.col(f"{new}.{DIGEST}") < F.col(f"{old}.{DIGEST}")))


def changes(silver: DataFrame, fresh: DataFrame, spec: CurateSpec = CurateSpec()) -> DataFrame:
    """What a merge of the curated rows ``fresh`` changes in ``silver``, both with
    digests and one row a key: the rows that enter with ``weight`` 1 and the stored
    rows that they replace with ``weight`` -1.

    The stored rows are cut to the fresh keys by a semi-join (broadcast where the
    planner finds the keys small enough, else shuffled by key) before whole rows meet.
    """
    columns, keys = [*SILVER_COLUMNS, DIGEST], list(spec.key)
    fresh = fresh.select(*columns)
    touched = silver.select(*columns).join(fresh.select(*keys), keys, "left_semi")
    n, o = fresh.alias("n"), touched.alias("o")
    met = n.join(o, [F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys], "left")
    found = F.col(f"o.{keys[0]}").isNotNull()
    replaced = F.coalesce(found & wins(spec, "n", "o"), F.lit(False))

    # One weight for each row that comes or goes; its columns are read from the joined
    # row by weight. (Unnesting two whole rows makes a method too long for the JVM to compile.)
    weights = F.when(replaced, F.array(F.lit(1), F.lit(-1))).when(~found, F.array(F.lit(1)))
    every = met.select(*[F.col(f"{a}.{c}").alias(f"{a}_{c}") for a in "no" for c in columns], F.explode_outer(weights).alias("weight"))
    return every.where(F.col("weight").isNotNull()).select(
        *[F.when(F.col("weight") > 0, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) for c in columns], "weight")


NORMAL = {"title": text.clean, "company": text.clean, "country_code": text.clean_lower}


def normalized(df: DataFrame) -> DataFrame:
    """Trim title and company; trim and lower-case the country code."""
    return df.withColumns({c: clean(c) for c, clean in NORMAL.items()})


def enrich(df: DataFrame, spec: CurateSpec = CurateSpec()) -> DataFrame:
    """Add posted_date, seniority, skills, clouds and skill_count.

    Expects normalised text (skills and seniority read the trimmed title).
    """
    searched = lexicon.skill_text("title", "description")
    out = df.withColumns(
        {
            "posted_date": dates.posted_date("created"),
            "seniority": lexicon.seniority("title", spec.seniority_classes),
            "skills": lexicon.skills(searched, spec.taxonomy),
            "clouds": lexicon.clouds(searched, spec.cloud_names, spec.taxonomy),
        }
    )
    return out.withColumn("skill_count", F.size("skills").cast("int"))


def curate(bronze: DataFrame, spec: CurateSpec = CurateSpec()) -> DataFrame:
    """Bronze history -> curated table: newest copy per key, normalised,
    enriched, projected to :data:`SILVER_COLUMNS`.

    A stored :data:`DIGEST` stays, as the last column. One shuffle (the dedupe);
    everything else is per-row expressions fused into the same codegen stage.
    """
    columns = [*SILVER_COLUMNS, *([DIGEST] if DIGEST in bronze.columns else [])]
    return enrich(normalized(dedupe(bronze, spec)), spec).select(*columns)
