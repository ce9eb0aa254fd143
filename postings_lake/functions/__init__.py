"""Column factories: each returns a ``pyspark.sql.Column`` built from
built-in functions, so it composes into any select and stays in codegen."""
from postings_lake.functions.dates import posted_date
from postings_lake.functions.lexicon import (
    CLOUD_SKILLS,
    SENIORITY_CLASSES,
    SKILL_TAXONOMY,
    boundary_pattern,
    clouds,
    seniority,
    skill_text,
    skills,
)
from postings_lake.functions.text import clean, clean_lower, contains_term

__all__ = [
    "CLOUD_SKILLS", "SENIORITY_CLASSES", "SKILL_TAXONOMY", "boundary_pattern", "clean",
    "clean_lower", "clouds", "contains_term", "posted_date",
    "seniority", "skill_text", "skills",
]
