"""Taxonomy-based tagging as native Column expressions.

Everything here builds plain ``rlike`` / ``contains`` / ``when`` / ``concat``
expressions at plan time, so the tagging runs inside whole-stage codegen on
the executors: no Python worker is involved and nothing is collected.

Word boundaries are written out as explicit character classes rather than
``\\b``: Java's ``\\b`` disagrees with Python's on thousands of code points
(combining marks, superscripts) and changed meaning between JDK releases. The
class form below gives the same answer as Python ``re`` with ``IGNORECASE`` for
every code point the JDK's Unicode tables know, and an RE2 spelling of the same
pattern (see :func:`boundary_pattern`) is what the DuckDB oracle uses.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES: must equal the reference's for identical results.
# Skill taxonomy, canonical name -> aliases (case-insensitive, word-bounded).
# An alias containing "?" is a regex fragment; every other alias is literal text.
# ---------------------------------------------------------------------------
SKILL_TAXONOMY: dict[str, tuple[str, ...]] = {
    "Python": ("python",),
    "SQL": ("sql",),
    "PySpark": ("pyspark",),
    "Spark": ("spark", "apache spark"),
    "Databricks": ("databricks",),
    "Delta Lake": ("delta lake", "delta tables?"),
    "Microsoft Fabric": ("microsoft fabric", "ms fabric"),
    "Snowflake": ("snowflake",),
    "dbt": ("dbt",),
    "Airflow": ("airflow",),
    "Kafka": ("kafka",),
    "Flink": ("flink",),
    "Azure": ("azure", "adf", "azure data factory", "synapse"),
    "AWS": ("aws", "redshift", "glue", "s3"),
    "GCP": ("gcp", "google cloud", "bigquery"),
    "Docker": ("docker",),
    "Kubernetes": ("kubernetes", "k8s"),
    "Terraform": ("terraform",),
    "PostgreSQL": ("postgresql", "postgres"),
    "MySQL": ("mysql",),
    "MongoDB": ("mongodb", "mongo"),
    "Hadoop": ("hadoop",),
    "Hive": ("hive",),
    "Scala": ("scala",),
    "Java": ("java",),
    "Power BI": ("power bi", "powerbi"),
    "Tableau": ("tableau",),
    "CI/CD": ("ci/cd", "ci cd", "github actions", "gitlab ci"),
}

# Cloud platforms singled out for the cloud-demand mart.
CLOUD_SKILLS: tuple[str, ...] = ("AWS", "Azure", "GCP")

# Seniority classes, tried in this order on the lower-cased title; first match
# wins, no match (or a null title) gives "unspecified".
SENIORITY_CLASSES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("junior", ("junior", "graduate", "entry", "trainee", "intern")),
    ("senior", ("senior", "lead", "principal", "staff", "head")),
    ("mid", ("medior", "mid level", "mid-level", "midlevel")),
)
SENIORITY_DEFAULT = "unspecified"
# --------------------------- end of fixed values ---------------------------

# Characters that count as part of a word on either side of a match.
SKILL_WORD_CLASS = r"\p{L}\p{N}_"
SENIORITY_WORD_CLASS = r"\p{L}\p{Nd}_"

_REGEX_META = set(r"\.^$|?*+()[]{}")

# FIXED VALUES: the only characters outside ASCII that match an ASCII letter
# under Unicode case-insensitive matching, and the letter each matches
# (long s, dotless i, dotted capital I, Kelvin sign).
_FOLDS_TO_ASCII = ("\u017f\u0131\u0130\u212a", "siik")


def _literal(text: str) -> str:
    """Escape regex metacharacters only; letters, digits, spaces, '/' and '-'
    stay as they are so one pattern text is valid in Java and RE2 alike."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in text)


def alias_fragment(alias: str) -> str:
    return alias if "?" in alias else _literal(alias)


def boundary_pattern(
    aliases: Sequence[str],
    word_class: str = SKILL_WORD_CLASS,
    *,
    dialect: str = "java",
    ignore_case: bool = True,
) -> str:
    """Pattern that finds any alias not touching a word character.

    ``dialect="java"`` is for Spark ``rlike``; ``dialect="re2"`` is the same
    pattern for DuckDB's ``regexp_matches``. The neighbouring characters may be
    consumed: callers only ask whether a match exists.
    """
    body = "|".join(alias_fragment(a) for a in aliases)
    end = r"\z" if dialect == "java" else "$"
    flags = ""
    if ignore_case:
        # Java needs UNICODE_CASE to fold like Python (e.g. long s to s).
        flags = "(?iu)" if dialect == "java" else "(?i)"
    return f"{flags}(?:^|[^{word_class}])(?:{body})(?:{end}|[^{word_class}])"


def literal_core(alias: str) -> str | None:
    """Lower-case text every match of ``alias`` must contain, or ``None``
    when the alias is a regex fragment with no literal part we rely on.
    ``"delta tables?"`` gives ``"delta table"``."""
    if "?" not in alias:
        return alias.lower()
    head = alias[:-1] if alias.endswith("?") else None
    if head and not any(ch in _REGEX_META for ch in head[:-1]):
        return head[:-1].lower()
    return None


def folded(text: Column) -> Column:
    """``text`` lower-cased after mapping the non-ASCII characters that fold
    onto ASCII letters: wherever a case-insensitive match of an ASCII alias
    exists, the alias occurs literally in this string."""
    src, dst = _FOLDS_TO_ASCII
    return F.lower(F.translate(text, src, dst))


def may_contain(lowered: Column, aliases: Sequence[str]) -> Column | None:
    """Cheap necessary condition (byte substring search) for any alias of
    ``aliases`` to match; ``None`` if some alias has no literal core."""
    cores = [literal_core(a) for a in aliases]
    if any(c is None or not c.isascii() for c in cores):
        return None
    cond = None
    for c in dict.fromkeys(cores):
        hit = lowered.contains(F.lit(c))
        cond = hit if cond is None else (cond | hit)
    return cond


def skill_text(title: Column | str, description: Column | str) -> Column:
    """Text the skills are searched in: title and description, nulls skipped."""
    return F.concat_ws(" ", _col(title), _col(description))


def skills(
    text: Column | str,
    taxonomy: Mapping[str, Sequence[str]] = SKILL_TAXONOMY,
) -> Column:
    """``array<string>`` of canonical names whose aliases occur in ``text``.

    Sorted by code point (Spark compares strings by UTF-8 bytes, which is the
    same order), unique, and ``[]`` for null or empty text.

    Each Unicode-aware regex runs only after a byte substring search on the
    folded text found one of the name's aliases, so most rows never reach the
    regex engine; the pre-check can only say "maybe", never "no" wrongly.

    The result is a ``concat`` of one-element-or-empty arrays rather than a
    null-filtering higher-order function: higher-order functions are evaluated
    without code generation, which would also switch off the sharing of the
    folded text between the pre-checks.
    """
    t = _col(text)
    low = folded(t)
    none = F.array().cast("array<string>")
    parts = []
    for name in sorted(taxonomy):
        match = t.rlike(boundary_pattern(taxonomy[name]))
        pre = may_contain(low, taxonomy[name])
        parts.append(F.when(match if pre is None else (pre & match), F.array(F.lit(name))).otherwise(none))
    if not parts:
        return none
    return F.concat(*parts)


def clouds(
    text: Column | str,
    cloud_names: Sequence[str] = CLOUD_SKILLS,
    taxonomy: Mapping[str, Sequence[str]] = SKILL_TAXONOMY,
) -> Column:
    """The cloud platforms among the skills of ``text``: only their names are
    searched for."""
    return skills(text, {c: taxonomy[c] for c in cloud_names if c in taxonomy})


def seniority(
    title: Column | str,
    classes: Sequence[tuple[str, Sequence[str]]] = SENIORITY_CLASSES,
    default: str = SENIORITY_DEFAULT,
) -> Column:
    """Seniority class of a job title; first matching class wins."""
    t = F.lower(_col(title))
    expr = None
    for label, words in classes:
        cond = t.rlike(boundary_pattern(words, SENIORITY_WORD_CLASS, ignore_case=False))
        pre = None
        for w in words:  # the pattern is case-sensitive on the lowered title
            hit = t.contains(F.lit(w))
            pre = hit if pre is None else (pre | hit)
        cond = pre & cond
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
