"""Folds of the log that go on: a fold's state is a row per key that can be merged with that of later observations.

A part of a state is a first or last value with its place (a struct of seq and value), a least or a greatest value. Merging takes,
for each key, the part with the least or greatest place, so a log folded at once and one folded batch by batch give the same."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from . import history


@dataclass(frozen=True)
class Part:
    """how: first, last (by seq), min or max; of: a column or expression; where: which observations count (all but for first_known
    and last_known, which want a value)."""

    how: str
    of: str
    where: str | None = None

    def observed(self) -> Column:
        value = F.expr(self.of) if self.how in ("min", "max") else F.struct("seq", F.expr(self.of).alias("value"))
        return F.when(F.expr(self.where), value) if self.where else value

    def merged(self, name: str) -> Column:
        if self.how == "min":
            return F.min(name)
        if self.how == "max":
            return F.max(name)
        return (F.min_by if self.how == "first" else F.max_by)(F.col(name), F.when(F.col(name).isNotNull(), F.col(name)["seq"]))

    def value(self, name: str) -> Column:
        return F.col(name) if self.how in ("min", "max") else F.col(name)["value"]


@dataclass(frozen=True)
class Fold:
    keys: dict[str, str]
    parts: dict[str, Part]

    def observed(self, log: DataFrame) -> DataFrame:
        """A state row for each observation."""
        return log.select(*(F.expr(e).alias(k) for k, e in self.keys.items()), *(p.observed().alias(n) for n, p in self.parts.items()))

    def merged(self, states: DataFrame) -> DataFrame:
        return states.groupBy(*self.keys).agg(*(p.merged(n).alias(n) for n, p in self.parts.items()))

    def of(self, log: DataFrame) -> DataFrame:
        return self.merged(self.observed(log))

    def values(self, state: DataFrame) -> DataFrame:
        return state.select(*self.keys, *(p.value(n).alias(n) for n, p in self.parts.items()))


def known(how: str, column: str) -> Part:
    return Part(how, column, f"{column} is not null")


_COMPLETE = "capture_status = 'complete'"

#: A row per key, as history.identities().
IDENTITIES = Fold({"dedup_key": "dedup_key"}, {
    "first_seq": Part("min", "seq"), "source": known("first", "source"), "source_job_id": known("first", "source_job_id"), "canonical_url": known("last", "canonical_url"),
    "first_seen_at": Part("first", "captured_at"), "last_seen_at": Part("max", "captured_at"), "first_seen_run_id": Part("first", "run_id"), "last_seen_run_id": known("last", "run_id"),
    "latest_hash": Part("last", "content_hash"), "latest_complete_hash": Part("last", "content_hash", _COMPLETE), "updated_at": Part("last", "written_at"),
})

#: A row per run, key, profile, query and location, as history.hits().
HITS = Fold({"run_id": "run_id", "dedup_key": "dedup_key"} | {c: f"coalesce({c}, '')" for c in ("profile", "query", "location")}, {
    "content_hash": Part("last", "content_hash"), "search_url": known("last", "search_url"), "hit_url": known("last", "hit_url"), "position": Part("min", "position"),
    "page_number": known("first", "page_number"), "filled": Part("last", "metadata", "metadata <> '{}'"), "began": Part("first", "metadata"), "discovered_at": Part("first", "discovered_at"),
})


def contents(columns: list[str]) -> Fold:
    """A row per key and content: the first observation of it, when it came, last came, last came complete, and was last seen."""
    first = f"named_struct({', '.join(f'{c!r}, {c}' for c in columns if c not in ('dedup_key', 'content_hash'))})"
    return Fold({"dedup_key": "dedup_key", "content_hash": "content_hash"}, {
        "v": Part("first", first), "first_seq": Part("min", "seq"), "at": Part("max", "seq"), "complete_at": Part("max", "seq", _COMPLETE), "seen": Part("max", "captured_at"),
    })


def hit_values(state: DataFrame) -> DataFrame:
    found = HITS.values(state)
    return found.withColumn("metadata", F.coalesce("filled", "began")).drop("filled", "began")


def latest(state: DataFrame, columns: list[str]) -> DataFrame:
    """history.latest() from the state of contents()."""
    return history.shown(contents(columns).values(state))
