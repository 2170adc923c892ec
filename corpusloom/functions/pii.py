"""Personal data: redaction and the types found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns in the order in which they apply, their tags and names.
RULES = (
    (r"(?U)[\w.+-]+@[\w-]+\.[\w.-]+", "[EMAIL]", "email"),
    (r"(?U)(?<!\d)(?:\d{1,3}\.){3}\d{1,3}(?!\d)", "[IP]", "ip"),
    (r"(?U)(?<![\d+])(?:\+84|0)\d{9}(?!\d)", "[PHONE]", "phone_vn"),
    (r"(?U)(?<!\d)(?:\d{12}|\d{9})(?!\d)", "[ID]", "cccd_cmnd"),
)


def redact(text: Column, vi_regex: bool = True) -> Column:
    """struct(text, types). Each pattern sees what those before have left; vi_regex=False leaves out the national numbers."""
    out, found = text, []
    for pattern, tag, name in RULES if vi_regex else RULES[:2]:
        found.append(F.when(F.rlike(out, F.lit(pattern)), F.lit(name)))
        out = F.regexp_replace(out, F.lit(pattern), F.lit(tag))
    return F.struct(out.alias("text"), F.filter(F.array(*found), lambda x: x.isNotNull()).alias("types"))
