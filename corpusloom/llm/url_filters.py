"""URL filters: host and path rules, and a path-template tree for what the rules leave open.

A url's path is a sequence of up to DEPTH segments, the rest is one more. Segments that are numbers, hexadecimal or mixed ids are
generalised at once. Then, level by level and for each host, the children of a node are merged where they are statistically similar:

* a child with labelled urls becomes part of the wildcard * unless it has MIN_CHILD urls or more and its labelled share of bad urls differs from that of its siblings by Z standard errors;
* a child without labels never joins labelled ones, but for those with fewer than MIN_CHILD urls at a variable segment (VARIABLE children or more, fewer than MIN_CHILD
  urls each on average), which are part of *; others become part of ~ unless they have MIN_CHILD urls or more and their shares of urls that end there, or go on with a generalised segment,
  differ from those of their siblings without labels;
* an only child, and a child without labels that has no sibling without labels, is kept.

Of each template that results the labelled urls give a smoothed purity, (bad + PRIOR * share) / (labelled + PRIOR) with share that of all labelled urls of the table. A template is rejected
at REJECT or more if it has MIN_LABELS labelled urls of its own; one without evidence is allowed.

Urls are first counted by host and generalised path, so that what follows has a row for each
distinct path and not for each url; the children of one node meet only as sums. Urls without a host are one host, the empty one. Everything here is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import LOWER, UPPER, cut

DEPTH, MIN_CHILD, VARIABLE, Z, PRIOR, REJECT, MIN_LABELS = 4, 5, 8, 1.96, 2.0, 0.8, 5
#: (block or allow, host, path prefix)
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
#: What a segment is generalised to, by the first pattern that fits the whole of it.
SHAPES = ((r"[0-9]+", "{number}"), (r"[0-9]+\.[A-Za-z]{2,5}", "{number.ext}"), (r"[0-9a-fA-F-]{16,}", "{hex}"), (r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_.-]{12,}", "{id}"))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """rule, verdict of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """Generalised segments, DEPTH + 1 at most, without empty ones at the end."""
    shape = lambda s: s

    def general(s: Column) -> Column:
        out = s
        for pattern, name in reversed(SHAPES):
            out = F.when(F.rlike(s, F.lit(f"^(?:{pattern})$")), F.lit(name)).otherwise(out)
        return shape(out)

    return F.transform(F.split(F.rtrim(F.substr(path, F.lit(2)), F.lit("/")), "/", DEPTH + 1), general)


def _differ(x: Column, n: Column, y: Column, m: Column) -> Column:
    """Whether x of n and y of m are shares that differ by over Z standard errors. Both n and m are 1 or more."""
    pool = (x + y) / (n + m)
    return F.abs(x / n - y / m) > Z * F.sqrt(pool * (1 - pool) * (1 / n + 1 / m))


def templates(urls: DataFrame) -> DataFrame:
    """urls: host, segs, n, labelled, bad (sums over the urls of a generalised path). Adds template, the branch it is in."""
    rows = urls.withColumn("template", F.lit(""))
    c = F.col
    for level in range(DEPTH + 1):
        after = F.get("segs", F.lit(level + 1))
        rows = cut(rows.withColumns({"_seg": F.coalesce(F.get("segs", F.lit(level)), F.lit("$")), "_e": F.when(after.isNull(), c("n")).otherwise(0), "_g": F.when(F.startswith(after, F.lit("{")), c("n")).otherwise(0)}))
        child = rows.groupBy("host", "template", "_seg").agg(F.sum("n").alias("cn"), F.sum("labelled").alias("l"), F.sum("bad").alias("b"), F.sum("_e").alias("e"), F.sum("_g").alias("g"))
        bare = lambda x: F.sum(F.when(c("l") == 0, c(x)).otherwise(0))
        node = child.groupBy("host", "template").agg(F.sum("cn").alias("an"), F.sum("l").alias("al"), F.sum("b").alias("ab"), F.count("*").alias("ac"), bare("cn").alias("un"), bare("e").alias("ue"), bare("g").alias("ug"))
        enough = c("cn") >= MIN_CHILD
        own = enough & (c("al") > c("l")) & _differ(c("b"), c("l"), c("ab") - c("b"), c("al") - c("l"))
        others = c("un") - c("cn")
        odd = enough & (_differ(c("e"), c("cn"), c("ue") - c("e"), others) | _differ(c("g"), c("cn"), c("ug") - c("g"), others))
        variable = (c("ac") >= VARIABLE) & (c("an") < MIN_CHILD * c("ac")) & ~enough
        name = F.when(c("cn") == c("an"), c("_seg")).when(c("l") > 0, F.when(own, c("_seg")).otherwise("*")).when(variable, "*").when(others == 0, c("_seg")).when(odd, c("_seg")).otherwise("~")
        named = child.join(node, ["host", "template"]).select("host", "template", "_seg", name.alias("_name"))
        rows = rows.join(named, ["host", "template", "_seg"]).withColumn("template", F.concat("template", F.lit("/"), "_name")).drop("_seg", "_name", "_e", "_g")
    return rows


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template of each row of pages (page_id, url). Urls that a rule judges are the labelled ones, bad if blocked."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = cut(urls.withColumns({"_r": rule_of(F.col("host"), F.col("path"), rules), "segs": segments(F.col("path"))}))
    known = F.col("_r").isNotNull()
    by = urls.groupBy("host", "segs").agg(F.count("*").alias("n"), F.count_if(known).alias("labelled"), F.count_if(known & (F.col("_r.verdict") == "block")).alias("bad"))
    tree = cut(templates(by))
    per = cut(tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")))
    bad_ones, labelled = per.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("labelled"), F.lit(0))).first()
    purity = (F.col("bad") + PRIOR * bad_ones / max(labelled, 1)) / (F.col("labelled") + PRIOR)
    bad = per.select("host", "template", ((F.col("labelled") >= MIN_LABELS) & (purity >= REJECT)).alias("_bad"))
    leaves = tree.join(bad, ["host", "template"]).select("host", "segs", "template", "_bad")
    out = urls.join(leaves, ["host", "segs"])
    verdict = F.coalesce(F.col("_r.verdict"), F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"), "template")
