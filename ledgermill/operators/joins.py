"""Lookups against what is known, enrichment of stubs, and merging of search cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import urls as U
from ..shared import saved
from . import history


def known(log: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Ids and canonical URLs of a source's complete records: an identity whose complete version names company, title,
    description and a URL. The identity's URL counts, else the version's own, else its source URL."""
    fields = ("capture_status", "company", "title", "description", "source_url", "canonical_url")
    said = lambda c: F.when(F.col(c).isNotNull(), F.struct("seq", c))
    contents = log.where(F.col("source") == source.lower()).groupBy("dedup_key", "content_hash").agg(
        history.first(F.struct(*fields)).alias("v"), F.max(F.when(history.is_complete(), F.col("seq"))).alias("at"), F.min(said("source_job_id")).alias("id"), F.max(said("canonical_url")).alias("url")
    )
    jobs = contents.groupBy("dedup_key").agg(history.last("v", "at", F.col("at").isNotNull()).alias("v"), F.min("id").alias("id"), F.max("url").alias("url"))
    rows = jobs.select("v.*", F.col("id.source_job_id").alias("_id"), F.col("url.canonical_url").alias("_url")).where(history.full())
    ids = rows.select(F.nullif(F.trim("_id"), F.lit("")).alias("source_job_id")).where("source_job_id is not null").distinct()
    urls = rows.select(U.canonicalize_url(F.coalesce("_url", "canonical_url", "source_url")).alias("canonical_url"))
    return ids, urls.where("canonical_url is not null").distinct()


def unknown(found: DataFrame, ids: DataFrame, urls: DataFrame) -> DataFrame:
    """Rows whose id and URL are both unknown: two anti joins, each by equality; a null matches nothing."""
    return found.join(ids, "source_job_id", "left_anti").join(urls, "canonical_url", "left_anti")


#: What a record without these is called; no placeholder makes it complete: fixed values.
PLACEHOLDERS = {"company": "Unknown company", "title": "Unknown role", "description": ""}


def enriched(stubs: DataFrame, details: DataFrame, key: str = "dedup_key", fields=None) -> DataFrame:
    """Stubs with their details: a detail's value wins, then the stub's (its id, posting date and run fields too), then
    placeholders. fields: the details' columns to take, all by default. Columns of either side are kept."""
    taken = [f for f in (fields or details.columns) if f != key]
    d = details.select(key, F.struct(*taken).alias("_detail"))
    have, texts = set(stubs.columns), {f for f, t in details.dtypes if t == "string"}

    def merged(f: str) -> Column:
        said = lambda c: F.nullif(c, F.lit("")) if f in texts else c
        found = F.coalesce(said(F.col("_detail")[f]), said(F.col(f))) if f in have else said(F.col("_detail")[f])
        return F.coalesce(found, F.lit(PLACEHOLDERS[f])) if f in PLACEHOLDERS else found

    return stubs.join(d, key, "left").withColumns({f: merged(f) for f in taken}).drop("_detail")


CARD_FIELDS = ("entity_urn", "href", "title", "company", "location", "posted_at", "card_text")


def merged_cards(cards: DataFrame, fields=CARD_FIELDS) -> DataFrame:
    """A row per card identity: the id of its URN or else of its link, the canonical link, or the link. Each field is the
    first value that isn't empty, in the order of seq; rank is by first arrival, from 1. A card without a link gets one
    from its URN; one with neither is left out."""
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    urn = F.nullif(F.regexp_extract("entity_urn", U.LISTING_URN, 1), F.lit(""))
    made = F.when(blank(F.col("href")), U.listing_url(urn, F.lit(None).cast("string"))).otherwise(F.col("href"))
    rows = cards.withColumn("href", made).where(~blank(F.col("href")))
    rows = rows.withColumn("identity", F.coalesce(U.extract_listing_id(F.col("entity_urn"), F.col("href")), U.canonicalize_url(F.col("href")), F.col("href")))
    one = rows.groupBy("identity").agg(F.min("seq").alias("first_seq"), *(history.first(f, where=~blank(F.col(f))).alias(f) for f in fields))
    return history.numbered(one, "first_seq", "rank")


def to_fetch(cards: DataFrame, ids: DataFrame, urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Discovery before details: every card's stub, and those whose details aren't known yet. Cards are merged and written
    first, so no detail is asked for before discovery is over."""
    found = saved(merged_cards(cards), "cards")
    listing = U.extract_listing_id(F.col("entity_urn"), F.col("href"))
    stubs = found.withColumns({"source_job_id": listing, "source_url": U.listing_url(listing, F.col("href"))}).withColumn("canonical_url", U.canonicalize_url(F.col("source_url")))
    return stubs, unknown(stubs, ids, urls)


def direct_stubs(urls: DataFrame) -> DataFrame:
    """urls: (rank, url). The first row of each listing, as a partial stub; ranks keep their gaps."""
    rows = urls.withColumn("source_job_id", U.extract_listing_id(F.col("url"))).withColumn("source_url", U.listing_url(F.col("source_job_id"), F.col("url")))
    one = rows.groupBy(F.coalesce("source_job_id", "source_url").alias("identity")).agg(F.min("rank").alias("search_rank"), F.min_by(F.struct("source_job_id", "source_url"), "rank").alias("r"))
    return one.select("r.source_job_id", "r.source_url", F.col("r.source_url").alias("canonical_url"), F.lit("Unknown company").alias("company"), F.lit("Unknown role").alias("title"), F.lit("").alias("description"), F.lit("partial").alias("capture_status"), "search_rank")


def due_requests(stubs: DataFrame, attempts: DataFrame, sessions: DataFrame, ids: DataFrame, urls: DataFrame, retries: int = 1) -> DataFrame:
    """The detail requests to make now: identity, its least rank, and the number of the attempt.

    stubs: (session, identity, rank, source_job_id, canonical_url), in as many sessions as found it; attempts: (identity, ok), a row
    for each request made; sessions: (session, stop_reason). A listing is due once every session that found it has stopped looking,
    if its details aren't known, no attempt was a success, and it has failed at most `retries` times. An attempt without an answer
    (ok is null) has failed. Each listing is asked for once at a time, whatever found it."""
    if retries < 0:
        raise ValueError("retries must not be negative")
    made = attempts.groupBy("identity").agg(F.count("*").alias("made"), F.coalesce(F.bool_or("ok"), F.lit(False)).alias("ok"))
    open_ones = sessions.where("stop_reason is null").select("session", F.lit(True).alias("_open"))
    found = unknown(stubs, ids, urls).join(open_ones, "session", "left")
    one = found.groupBy("identity").agg(F.min("rank").alias("rank"), F.coalesce(F.bool_or("_open"), F.lit(False)).alias("open")).where(~F.col("open"))
    rows = one.join(made, "identity", "left").where(~F.coalesce("ok", F.lit(False)) & (F.coalesce("made", F.lit(0)) <= retries))
    return rows.select("identity", "rank", (F.coalesce("made", F.lit(0)) + 1).alias("attempt"))
