"""Detail pages to records: one extraction, then built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify, html, text as T, urls as U
from ..shared import modest_batches
from .joins import PLACEHOLDERS


def details(pages: DataFrame, today: Column | None = None, url_col: str = "url", html_col: str = "html", loaded: Column | None = None, stub: str | None = None) -> DataFrame:
    """A record per page. A page is complete if its description was loaded and it names description, company and title
    itself; placeholders for missing ones don't count. stub: the name of a struct column with the search card's record, whose
    id, posting date, company, title, description and location stand in for what the page lacks; its run fields stay in it. The date
    is the posting's, if that can be read, else the page's, whether or not that can be read, and the stub's only where the page says
    none."""
    df = modest_batches(pages).withColumn("_p", html.extracted(F.col(html_col), F.col(url_col)))
    p = lambda c: F.col(f"_p.{c}")
    title = F.coalesce(F.nullif(p("title"), F.lit("")), F.nullif(T.clean_text(F.split_part(p("page_title"), F.lit(" | "), F.lit(1))), F.lit("")), F.lit(""))
    known = set(pages.schema[stub].dataType.names) if stub else set()
    of_stub = lambda c: F.col(stub)[c] if c in known else F.lit(None).cast("string")
    today = F.current_date() if today is None else today
    listing_id = U.extract_listing_id(p("urn"), p("canonical_url"), F.col(url_col), of_stub("source_job_id"))
    place = classify.workplace(p("location_type"), p("description"))
    complete = (F.lit(True) if loaded is None else loaded) & (p("description") != "") & (p("company") != "") & (title != "")
    pay = html.salary(p("base_salary"))
    url = U.listing_url(listing_id, p("canonical_url"))
    return df.select(
        *pages.columns,
        listing_id.alias("source_job_id"),
        url.alias("source_url"),
        url.alias("canonical_url"),
        p("apply_url").alias("apply_url"),
        F.coalesce(F.nullif(p("company"), F.lit("")), F.nullif(of_stub("company"), F.lit("")), F.lit(PLACEHOLDERS["company"])).alias("company"),
        F.coalesce(F.nullif(title, F.lit("")), F.nullif(of_stub("title"), F.lit("")), F.lit(PLACEHOLDERS["title"])).alias("title"),
        F.coalesce(F.nullif(p("description"), F.lit("")), of_stub("description"), F.lit("")).alias("description"),
        p("description_html").alias("description_html"),
        F.coalesce(F.nullif(p("location"), F.lit("")), of_stub("location")).alias("location"),
        place["type"].alias("workplace_type"),
        place["inferred"].alias("workplace_type_inferred"),
        classify.employment_type(p("employment_raw")).alias("employment_type"),
        F.coalesce(T.parse_date(p("posted_json"), today), T.parse_date(F.coalesce(F.nullif(p("posted_raw"), F.lit("")), of_stub("posted_at")), today)).alias("posted_at"),
        *(p(c).alias(c) for c in ("valid_through", "applicants", "seniority_level", "job_function", "industries")),
        *(pay[c].alias(c) for c in ("salary_min", "salary_max", "salary_currency", "salary_interval", "salary_text")),
        F.when(complete, "complete").otherwise("partial").alias("capture_status"),
    )


def search_cards(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per card of each landed search page: the page's columns but its markup, the card's place in it (from 0), and what it says
    (html.CARD). Pages without cards have none."""
    kept = [c for c in pages.columns if c != html_col]
    rows = modest_batches(pages).select(*kept, F.posexplode(html.cards_in(F.col(html_col), F.col(url_col))).alias("place", "card"))
    return rows.select(*kept, F.col("place").cast("long").alias("place"), *(F.col(f"card.{f}").alias(f) for f in html.CARD))
