"""Licence tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"
# Tags in order of search; share-alike comes before plain attribution, as its addresses begin alike.
PATTERNS = {
    "cc0": (r"creativecommons\.org/publicdomain/zero", r"\bcc0\b"),
    "public-domain": (r"creativecommons\.org/publicdomain/mark", r"public domain"),
    "cc-by-sa": (r"creativecommons\.org/licenses/by-sa", r"\bcc[ -]by[ -]sa\b"),
    "cc-by": (r"creativecommons\.org/licenses/by", r"\bcc[ -]by\b"),
    "odc-by": (r"opendatacommons\.org/licenses/by", r"\bodc[ -]by\b"),
}
TAGS = (*PATTERNS, UNKNOWN)


def detect(text: Column, headers: Column | None = None) -> Column:
    """The first tag whose mark is in the text (or in the header values), else unknown."""
    low = F.lower(text if headers is None else F.concat(text, F.lit(" "), F.array_join(F.map_values(headers), " ")))
    out = None
    for tag, patterns in PATTERNS.items():
        hit = F.rlike(low, F.lit("(?U)" + "|".join(patterns)))
        out = F.when(hit, tag) if out is None else out.when(hit, tag)
    return F.coalesce(out.otherwise(UNKNOWN), F.lit(UNKNOWN))


def resolve(tag: Column, html: Column) -> Column:
    """A valid tag wins, unknown included; else what the page says."""
    return F.when(tag.isin(*TAGS), tag).otherwise(detect(html))


def coerce(tag: Column) -> Column:
    return F.when(tag.isin(*TAGS), tag).otherwise(F.lit(UNKNOWN))
