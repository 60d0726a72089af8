"""Records of any accepted spelling to the columns of a snapshot, with identity and content hash."""

from __future__ import annotations

from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T, urls as U
from ..functions.canonical import canonical_json, content_hash

#: Names under which a field may come, in order: fixed values.
ALIASES = {
    "source_url": ("source_url", "job_url", "url", "canonical_url"),
    "canonical_url": ("canonical_url", "source_url", "job_url", "url"),
    "source_job_id": ("source_job_id", "external_id", "linkedin_job_id", "job_id"),
    "apply_url": ("apply_url", "application_url"),
    "company": ("company", "company_name"),
    "company_url": ("company_url",),
    "company_logo_url": ("company_logo_url", "logo_url"),
    "title": ("title", "job_title"),
    "location": ("location", "job_location"),
    "workplace_type": ("workplace_type", "workplace", "remote_type"),
    "employment_type": ("employment_type", "job_type"),
    "seniority_level": ("seniority_level", "experience_level"),
    "job_function": ("job_function", "job_functions"),
    "industries_json": ("industries", "industry"),
    "posted_at": ("posted_at", "published_at", "date_posted"),
    "valid_through": ("valid_through", "expires_at"),
    "salary_min": ("salary_min", "salary_from"),
    "salary_max": ("salary_max", "salary_to"),
    "salary_currency": ("salary_currency", "currency"),
    "salary_interval": ("salary_interval", "pay_period"),
    "salary_text": ("salary_text", "compensation_text"),
    "description": ("description", "job_description"),
    "description_html": ("description_html", "job_description_html"),
    "applicants": ("applicants", "applicants_text"),
    "applicants_count": ("applicants_count", "applicant_count", "applicants"),
    "captured_at": ("captured_at", "scraped_at", "collected_at"),
}
#: Fields of a snapshot, which content hashes cover: fixed values.
SNAPSHOT_FIELDS = (
    "source", "source_job_id", "source_url", "canonical_url", "apply_url", "company", "company_url", "company_logo_url", "title", "location", "workplace_type",
    "employment_type", "seniority_level", "job_function", "industries_json", "posted_at", "valid_through", "salary_min", "salary_max", "salary_currency",
    "salary_interval", "salary_text", "description", "description_html", "applicants", "applicants_count", "capture_status",
)
_KINDS = {
    U.canonicalize_url: ("source_url", "canonical_url", "apply_url", "company_url"),
    T.json_text: ("job_function", "industries_json"),
    T.iso_value: ("posted_at", "valid_through", "captured_at"),
    T.decimal_text: ("salary_min", "salary_max"),
    T.description_text: ("description", "description_html"),
    T.integer: ("applicants_count",),
}
_MAKE = {field: f for f, fields in _KINDS.items() for field in fields}


def default_key(source: Column, source_job_id: Column, canonical_url: Column) -> Column:
    """source:id:ID, or else source:url:URL; null without either."""
    return F.coalesce(F.concat(source, F.lit(":id:"), source_job_id), F.concat(source, F.lit(":url:"), canonical_url))


def dedup_key(source: Column, explicit: Column, source_job_id: Column, canonical_url: Column) -> Column:
    """An explicit key if it is scoped to the source (else null: invalid), or the default key."""
    e = T.text(explicit)
    return F.when(e.isNotNull(), F.when(e.startswith(F.concat(source, F.lit(":"))), e)).otherwise(default_key(source, source_job_id, canonical_url))


def normalized(records: DataFrame, now: Column | None = None, keep: tuple[str, ...] = (), include_raw: bool = True) -> DataFrame:
    """The snapshot columns, captured_at, raw_json, dedup_key (null: invalid) and content_hash, with the columns in keep.
    Without a status a record is complete if it has a description. now: captured_at where there is none. include_raw: whether a
    raw_json that is made of the record repeats its markup."""
    kinds = tuple((f.name, f.dataType.typeName() in ("array", "struct", "map")) for f in records.schema)
    first, second, third = _columns(id(SparkContext._gateway), kinds, include_raw)
    stamp = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    out = records.select(*keep, *first).withColumns(second | {"captured_at": F.coalesce("captured_at", stamp)})
    return out.withColumn("dedup_key", third).withColumn("content_hash", content_hash(SNAPSHOT_FIELDS)).drop("_status", "_key")


@lru_cache(maxsize=32)
def _columns(gateway: int, kinds: tuple[tuple[str, bool], ...], include_raw: bool) -> tuple[list[Column], dict[str, Column], Column]:
    """The expressions of normalized() for records of these columns (name, whether it is nested). Writing them takes thousands of
    calls of the JVM behind `gateway`, so those for one kind of records are written once."""
    have = {name for name, _ in kinds}

    def of(field: str) -> Column:
        cols = [F.to_json(F.col(a)) if dict(kinds)[a] else F.col(a) for a in ALIASES[field] if a in have]
        return T.first_value(*cols)

    def col(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    fields = {f: _MAKE.get(f, T.text)(of(f)) for f in ALIASES}
    source = F.lower(F.coalesce(T.text(col("source")), F.lit("other")))
    extras = F.to_json(F.struct(*(F.col(c) for c in sorted(have) if include_raw or c not in MARKUP)))
    raw = T.first_value(col("raw_json"), col("raw"))
    raw_json = F.when(raw.isNull(), extras).otherwise(F.coalesce(canonical_json(raw), F.concat(F.lit('{"value":'), T.quoted(raw), F.lit("}"))))
    first = [source.alias("source"), *(c.alias(f) for f, c in fields.items()), T.text(col("capture_status")).alias("_status"), col("dedup_key").alias("_key"), raw_json.alias("raw_json")]
    site_id = U.extract_source_job_id(F.coalesce("canonical_url", "source_url"))
    second = {
        "source_job_id": F.coalesce("source_job_id", F.when(F.col("source") == "linkedin", site_id)),
        "capture_status": F.coalesce("_status", F.when(F.col("description").isNotNull(), "complete").otherwise("partial")),
    }
    return first, second, dedup_key(F.col("source"), F.col("_key"), F.col("source_job_id"), F.col("canonical_url"))


#: Columns of markup.
MARKUP = ("raw_html", "description_html")


def without_raw(records: DataFrame) -> DataFrame:
    """Records without their markup, which raw_json would repeat."""
    return records.drop(*MARKUP)


#: Values that enumerated fields may have: fixed values.
ENUMS = {
    "workplace_type": ("remote", "hybrid", "on-site", "unknown"),
    "employment_type": ("full-time", "contract", "part-time", "temporary", "internship", "unknown"),
    "salary_interval": ("hour", "day", "month", "year"),
    "capture_status": ("partial", "complete"),
}


def problem(records: DataFrame) -> Column:
    """Why a record isn't valid, without its values; null if it is."""
    have = set(records.columns)
    rules = [(~F.coalesce(F.col("source").rlike("^[a-z0-9][a-z0-9_-]*$"), F.lit(False)), "source")] if "source" in have else [(F.lit(True), "source")]
    rules += [(~F.coalesce(U.is_absolute(F.trim("source_url")), F.lit(False)), "source_url")] if "source_url" in have else [(F.lit(True), "source_url")]
    rules += [(F.col(c).isNull() if c in have else F.lit(True), c) for c in ("company", "title")]
    rules += [(F.col(c).isNotNull() & ~F.col(c).isin(*values), c) for c, values in ENUMS.items() if c in have]
    rules += [(F.col(c).isNotNull() & F.trim(F.col(c).cast("string")).try_cast(kind).isNull(), c) for c, kind in (("salary_min", "decimal(38,18)"), ("salary_max", "decimal(38,18)"), ("posted_at", "date"), ("search_rank", "bigint")) if c in have]
    return F.coalesce(*(F.when(bad, F.lit(f"invalid {name}")) for bad, name in rules))


def downgraded(records: DataFrame) -> DataFrame:
    """Records without company, title or description count as partial whatever they say; enumerated fields get their defaults."""
    have, empty = set(records.columns), F.lit(None).cast("string")
    said = lambda c: T.text(F.col(c)).isNotNull() if c in have else F.lit(False)
    full = said("company") & said("title") & said("description")
    status = F.col("capture_status") if "capture_status" in have else empty
    out = records.withColumn("capture_status", F.when(full, F.coalesce(status, F.lit("complete"))).otherwise("partial"))
    return out.withColumns({c: F.coalesce(F.col(c) if c in have else empty, F.lit("unknown")) for c in ("workplace_type", "employment_type")})


def owned(records: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Records of the source, and those that claim another."""
    same = F.coalesce(F.col("source") == source, F.lit(False))
    return records.where(same), records.where(~same)
