"""Classifiers and display names as literal maps and patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import casefold_key, lookup, text

#: Spellings of employment types: fixed values.
EMPLOYMENT = {
    "full-time": "full-time",
    "full time": "full-time",
    "полный рабочий день": "full-time",
    "полная занятость": "full-time",
    "contractor": "contract",
    "contract": "contract",
    "контракт": "contract",
    "работа по контракту": "contract",
    "part-time": "part-time",
    "part time": "part-time",
    "неполный рабочий день": "part-time",
    "частичная занятость": "part-time",
    "temporary": "temporary",
    "временная работа": "temporary",
    "internship": "internship",
    "intern": "internship",
    "стажировка": "internship",
}
#: Display names: fixed values.
WORKPLACE_NAMES = {
    "en": {"remote": "Remote", "hybrid": "Hybrid", "on-site": "On-site", "onsite": "On-site", "unknown": "Not specified"},
    "ru": {"remote": "Удалённо", "hybrid": "Гибрид", "on-site": "Офис", "onsite": "Офис", "unknown": "Не указано"},
}
EMPLOYMENT_NAMES = {
    "en": {"full-time": "Full-time", "contract": "Contract", "part-time": "Part-time", "temporary": "Temporary", "internship": "Internship", "unknown": "Not specified"},
    "ru": {"full-time": "Полная занятость", "contract": "Контракт", "part-time": "Частичная занятость", "temporary": "Временная", "internship": "Стажировка", "unknown": "Не указано"},
}


def employment_type(c: Column) -> Column:
    return lookup(F.replace(casefold_key(c), F.lit("_"), F.lit("-")), EMPLOYMENT, F.lit("unknown"))


#: What in a description tells the workplace, in order: fixed values.
WORKPLACE_PATTERNS = {"hybrid": r"\bhybrid\b", "on-site": r"\b(on[- ]site|onsite)\b", "remote": r"\b(remote|work from home)\b"}


def workplace(location_type: Column, description: Column) -> Column:
    """(type, inferred): stated remote first, then what the description says."""
    stated, said = casefold_key(location_type), F.lower(F.coalesce(description, F.lit("")))

    def found(kind: str, inferred: bool) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.lit(inferred).alias("inferred"))

    kind = F.when(stated.contains("telecommute") | (stated == "remote"), found("remote", False))
    for name, pattern in WORKPLACE_PATTERNS.items():
        kind = kind.when(said.rlike(f"(?U){pattern}"), found(name, True))
    return kind.otherwise(found("unknown", False))


def display(c: Column, names: dict[str, str]) -> Column:
    """The display name; unknown values pass."""
    t = F.coalesce(text(c), F.lit(""))
    return lookup(F.lower(t), names, t)
