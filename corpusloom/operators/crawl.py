"""Site probing and crawling over a table of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.config import Crawl
from corpusloom.functions import html, licence
from corpusloom.functions import text as tx
from corpusloom.functions.lineage import Scratch, cut

DELAY_CAP, HOST_FACTOR = 30.0, 50


def parse_robots(text: Column) -> Column:
    """struct(crawl_delay, sitemaps, disallow) of all sections; the last valid delay counts."""
    rows = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\R", -1), tx.strip), lambda x: ~F.startswith(x, F.lit("#")) & F.contains(x, F.lit(":")))
    pairs = F.transform(rows, lambda x: F.struct(F.lower(tx.strip(F.substring_index(x, ":", 1))).alias("k"), tx.strip(F.substr(x, F.locate(":", x) + 1)).alias("v")))
    of = lambda p, k: F.transform(F.filter(p, lambda x: (x["k"] == k) & (x["v"] != "")), lambda x: x["v"])

    def parts(p: Column) -> Column:
        delays = F.filter(F.transform(of(p, "crawl-delay"), lambda v: v.try_cast("double")), lambda v: v.isNotNull())
        return F.struct(F.try_element_at(delays, F.lit(-1)).alias("crawl_delay"), of(p, "sitemap").alias("sitemaps"), of(p, "disallow").alias("disallow"))

    return tx.let(pairs, parts)


def parse_sitemap(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))


def source_profile(pages: DataFrame) -> DataFrame:
    """pages: url, html, robots, headers (map), sitemap, each nullable. What is known of a source before it is crawled; an unreachable page is unknown and http."""
    robots = parse_robots(F.col("robots"))
    reached = F.col("html").isNotNull()
    return pages.select(
        "url", F.when(reached, html.render_mode(F.col("html"))).otherwise("http").alias("render"), robots["crawl_delay"].alias("crawl_delay"),
        F.when(reached, licence.detect(F.col("html"), F.coalesce("headers", F.create_map().cast("map<string,string>")))).otherwise(licence.UNKNOWN).alias("license"),
        F.col("headers")["content-type"].alias("content_type"), F.coalesce(parse_sitemap(F.col("sitemap")), F.array().cast("array<string>")).alias("seed_urls"),
        F.coalesce(html.feeds(F.col("html")), F.array().cast("array<string>")).alias("feeds"), robots["disallow"].alias("disallow"), reached.alias("fetched"))


def check(cfg: Crawl, renderer: object | None = None) -> None:
    """Refuses to crawl without robots rules, or with a browser that isn't there."""
    if not cfg.respect_robots:
        raise ValueError("robots rules are always respected")
    if cfg.render == "browser" and renderer is None:
        raise ValueError("render=browser without a renderer")


def delay_of(crawl_delay: Column, cfg: Crawl) -> Column:
    return F.least(F.greatest(F.lit(cfg.politeness_delay), F.coalesce(crawl_delay, F.lit(0.0))), F.lit(DELAY_CAP))


def page_links(pages: DataFrame) -> DataFrame:
    """url, pos, link of each absolute link, repeats included."""
    return pages.select("url", F.posexplode(html.links(F.col("html"), F.col("url"))).alias("pos", "link"))


def allowed(url: Column, disallow: Column) -> Column:
    """Whether no disallowed prefix fits the path; a null list allows all."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    path = F.when(path == "", "/").otherwise(path)
    return ~F.coalesce(F.exists(disallow, lambda d: F.startswith(path, d)), F.lit(False))


def crawl(pages: DataFrame, seeds: DataFrame, cfg: Crawl, robots: DataFrame | None = None) -> DataFrame:
    """Breadth-first over a closed table of pages (url, html) from seeds (url): url, depth, outcome (fetched, fetch_failed, url_excluded, robots_disallowed, host_cap, page_cap).

    Links stay on the hosts of the seeds. robots: host, disallow. A level is what the one before links to and no level had. The caps on pages of a host and
    in all are the settings' own and count in order of depth, then url."""
    check(cfg)
    scratch = Scratch(pages.sparkSession)
    seeds = seeds.select("url").distinct()
    hosts = scratch.cut(seeds.select(tx.url_host(F.col("url")).alias("host")).distinct())
    found = scratch.cut(page_links(pages).select("url", "link").distinct())
    level = scratch.cut(seeds.select("url", F.lit(0).alias("depth")))
    seen = level
    ok = F.lit(True)
    for x in cfg.url_exclude:
        ok = ok & ~F.rlike("url", F.lit(x))
    for depth in range(1, cfg.max_depth + 1):
        nxt = level.filter(ok).join(found, "url").select(F.col("link").alias("url")).distinct()
        nxt = nxt.withColumn("host", tx.url_host(F.col("url"))).join(hosts, "host", "left_semi").drop("host").join(seen.select("url"), "url", "left_anti")
        level = scratch.cut(nxt.withColumn("depth", F.lit(depth)))
        if level.isEmpty():
            break
        seen = scratch.cut(seen.unionByName(level))
    rows = seen.withColumn("host", tx.url_host(F.col("url")))
    if robots is not None:
        rows = rows.join(robots.select("host", "disallow"), "host", "left")
    else:
        rows = rows.withColumn("disallow", F.lit(None).cast("array<string>"))
    rows = rows.join(pages.select("url", F.lit(True).alias("there")).distinct(), "url", "left")
    first = F.when(~ok, "url_excluded").when(~allowed(F.col("url"), F.col("disallow")), "robots_disallowed").when(F.col("there").isNull(), "fetch_failed")
    rows = cut(rows.select("url", "depth", "host", first.alias("outcome")))
    fine = rows.filter("outcome IS NULL").drop("outcome")
    place = F.row_number().over(Window.partitionBy("host").orderBy("depth", "url"))
    under = cut(fine.withColumn("_place", place).filter(F.col("_place") <= cfg.per_host_concurrency * HOST_FACTOR).drop("_place"))  # cut to the cap before the shuffle
    kept = cut(under.orderBy("depth", "url").limit(cfg.max_pages).withColumn("outcome", F.lit("fetched")))
    beyond = under.join(kept.select("url"), "url", "left_anti").withColumn("outcome", F.lit("page_cap"))
    over = fine.join(under.select("url"), "url", "left_anti").withColumn("outcome", F.lit("host_cap"))
    return kept.unionByName(over).unionByName(beyond).unionByName(rows.filter("outcome IS NOT NULL")).drop("host")
