"""The extract stage: raw pages to documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import html, licence
from corpusloom.functions import text as tx


def extract(raw: DataFrame, backend: Callable[[Column], Column] | None = None, name: str = html.FALLBACK, pdf: Callable[[Column], Column] | None = None) -> DataFrame:
    """raw: source_url and html (or content), optionally license, crawl_ts, content_type, pdf_path, title. Adds id, text, license, extractor, title, drop_reason (null to keep).

    backend: Column of html -> Column struct(text, title), in place of the parser here; pdf: Column of paths -> Column of text."""
    cols = raw.columns
    col = lambda c: F.col(c) if c in cols else F.lit(None).cast("string")
    page = F.coalesce(*[F.col(c) for c in ("html", "content") if c in cols])
    is_pdf = F.contains(F.lower(F.coalesce(col("content_type"), F.lit(""))), F.lit("pdf")) | (F.coalesce(col("pdf_path"), F.lit("")) != "")
    rows = raw.withColumn("_html", page).withColumn("_x", (backend or html.html_text)(F.when(is_pdf, "").otherwise(F.coalesce(page, F.lit("")))))
    has_html = tx.strip(F.coalesce("_html", F.lit(""))) != ""
    pdf_text = pdf(col("pdf_path")) if pdf is not None else F.lit(None).cast("string")
    text = F.when(is_pdf, pdf_text).otherwise(F.col("_x.text"))
    empty = F.coalesce(text, F.lit("")) == ""
    reason = (
        F.when(F.coalesce("source_url", F.lit("")) == "", "no_source_url").when(is_pdf & (F.coalesce(col("pdf_path"), F.lit("")) == ""), "pdf_no_path").when(is_pdf & empty, "empty_extract_pdf")
        .when(~is_pdf & ~has_html, "no_content").when(~is_pdf & empty, "empty_extract_html")
    )
    tag = F.when(is_pdf, licence.coerce(col("license"))).otherwise(licence.resolve(col("license"), F.coalesce("_html", F.lit(""))))
    engine = F.when(is_pdf, "pdf").otherwise(name)
    return rows.select(*[c for c in cols if c not in ("html", "content", "license", "title", "text", "id", "extractor")], tx.stable_id(F.coalesce("source_url", F.lit("")), engine).alias("id"), text.alias("text"), F.coalesce(tag, F.lit(licence.UNKNOWN)).alias("license"), engine.alias("extractor"), F.coalesce(col("title"), F.col("_x.title")).alias("title"), reason.alias("drop_reason"))
