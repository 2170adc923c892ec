import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from corpusloom.llm import url_filters as u

URLS = [
    "http://A.Example.COM/en/7x?q#f", "https://example.com/en/71", "https://example.com/en/8", "http://x.net/de/1", "http://example.net/de/81", "http://sub.example.net/de/8", "http://y.org/es/", "http://notexample.net/de/8",
    "http://com/en/", "http://xcom/en/", "nothing", None, "", "://", "a://b", "http://h.example?x=http://z/y", "http://h.example#/en/", "http://ÄB.Example/é/ü", "http://u@h.com:80/en/1", "x http://q.com/en/a://b", "http://h.com/en/\n2",
]


def brute(url, rules=u.RULES):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda x: len(x[0])) if fits else (None, None))


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate([*URLS, URLS[0]])], "page_id long, url string, host string")
    got = {r.page_id: r for r in u.judge(df).collect()}
    assert len(got) == len(URLS) + 1
    for i, x in enumerate(URLS):
        host, path, rule, verdict = brute(x)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), x
        assert got[i].verdict == verdict or verdict is None and got[i].verdict in ("allow", "block")


def test_templates_follow_the_labels(spark):
    """One branch of a host is blocked by the rules nearly everywhere, another allowed."""
    rules = (("block", "s.example", "/shop/1"), ("block", "s.example", "/shop/2"), ("block", "s.example", "/shop/3"), ("allow", "s.example", "/news/1"), ("allow", "s.example", "/news/2"))
    urls = [f"http://s.example/{b}/{i}" for b in ("shop", "news") for i in range(10, 100)] + ["http://s.example/shop/abc-def", "http://s.example/about", "http://t.example/shop/99"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.path if r.host == "s.example" else r.host: r for r in u.judge(df, rules).collect()}
    assert got["/shop/77"].rule is None and got["/shop/77"].verdict == "block" and got["/shop/77"].template.startswith("/shop/")
    assert got["/news/77"].verdict == "allow" and got["t.example"].verdict == "allow"


def shape(s):
    for pattern, name in u.SHAPES:
        if re.fullmatch(pattern, s):
            return name
    return s


def differ(x, n, y, m):
    pool = (x + y) / (n + m)
    return abs(x / n - y / m) > u.Z * math.sqrt(pool * (1 - pool) * (1 / n + 1 / m))


def plain_tree(urls, rules):
    """urls: {page_id: url}. {page_id: (template, verdict)} by a tree of dictionaries, node by node."""
    rows, groups = {}, defaultdict(list)
    for i, url in urls.items():
        host, path, _, verdict = brute(url, rules)
        parts = path[1:].rstrip("/").split("/", u.DEPTH)
        rows[i] = (host, [shape(s) for s in parts], verdict)
        groups[host, ""].append(i)
    for level in range(u.DEPTH + 1):
        nodes, groups = groups, defaultdict(list)
        for (host, template), ids in nodes.items():
            at = lambda i, k: rows[i][1][k] if k < len(rows[i][1]) else None
            kids = defaultdict(list)
            for i in ids:
                kids["$" if at(i, level) is None else at(i, level)].append(i)  # noqa: B023
            known = lambda of: [i for i in of if rows[i][2]]
            bad = lambda of: sum(rows[i][2] == "block" for i in of)
            ends = lambda of: sum(at(i, level + 1) is None for i in of)  # noqa: B023, E731
            shaped = lambda of: sum((at(i, level + 1) or "").startswith("{") for i in of)  # noqa: B023, E731
            for seg, own in kids.items():
                rest = [i for s, of in kids.items() if s != seg for i in of]
                bare = [i for s, of in kids.items() if s != seg and not known(of) for i in of]
                enough = len(own) >= u.MIN_CHILD
                if not rest:
                    name = seg
                elif known(own):
                    name = seg if enough and known(rest) and differ(bad(own), len(known(own)), bad(rest), len(known(rest))) else "*"
                elif len(kids) >= u.VARIABLE and len(ids) < u.MIN_CHILD * len(kids) and not enough:
                    name = "*"
                elif not bare or enough and any(differ(f(own), len(own), f(bare), len(bare)) for f in (ends, shaped)):
                    name = seg
                else:
                    name = "~"
                groups[host, f"{template}/{name}"] += own
    labels = Counter(v for _, _, v in rows.values())
    share = labels["block"] / max(1, labels["block"] + labels["allow"])
    out = {}
    for (_, template), ids in groups.items():
        known = [rows[i][2] for i in ids if rows[i][2]]
        pure = len(known) >= u.MIN_LABELS and (known.count("block") + u.PRIOR * share) / (len(known) + u.PRIOR) >= u.REJECT
        for i in ids:
            out[i] = template, rows[i][2] or ("block" if pure else "allow")
    return out


def test_against_a_plain_tree(spark):
    rng = random.Random(7)
    rules = (("block", "h.example", "/a/1"), ("allow", "h.example", "/a/2"), ("block", "h.example", "/b"), ("block", "i.example", "/x/y/9"), ("allow", "i.example", "/x"), ("block", "j.example", "/s/k"))
    seg = lambda: rng.choice(["a", "b", "c", "x", "y", "s", str(rng.randrange(30)), f"{rng.randrange(99)}.html", f"slug-{rng.randrange(400)}", f"k{rng.randrange(50)}", ""])
    urls = {i: f"http://{rng.choice(['h', 'i', 'j', 'w.h'])}.example/" + "/".join(seg() for _ in range(rng.choice([0, 1, 1, 2, 2, 2, 3, 4, 7]))) for i in range(3000)}
    urls |= {i + 3000: f"http://j.example/s/{rng.choice(['k', 'm'])}{rng.randrange(10**6)}z" for i in range(200)}
    df = spark.createDataFrame(list(urls.items()), "page_id long, url string").repartition(3)
    got = {r.page_id: (r.template, r.verdict) for r in u.judge(df, rules).collect()}
    want = plain_tree(urls, rules)
    assert got == want
    assert any(v == "block" and not brute(urls[i], rules)[2] for i, (_, v) in want.items())


def test_no_verdict_without_evidence(spark):
    """Of urls that no rule judges only those are blocked whose template has labelled urls of its own, nearly all of them bad."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    out = u.judge(pages)
    known = F.col("rule").isNotNull()
    by = out.groupBy("host", "template").agg(F.count_if(known).alias("l"), F.count_if(known & (F.col("verdict") == "block")).alias("b"), F.count_if(~known & (F.col("verdict") == "block")).alias("k"))
    assert by.filter((F.col("k") > 0) & ((F.col("l") < u.MIN_LABELS) | (F.col("b") < 0.7 * F.col("l")))).count() == 0


def test_shapes(spark):
    paths = ["/2024/05/my-title", "/a/1234.html", "/x/0123456789abcdef0123/", "/p/a1b2c3d4e5f6g7", "", "/", "/a/b/c/d/e/f"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").coalesce(1).select(u.segments(F.col("p"))).collect()]
    assert got == [["{number}", "{number}", "my-title"], ["a", "{number.ext}"], ["x", "{hex}"], ["p", "{id}"], [""], [""], ["a", "b", "c", "d", "e/f"]]


def test_empty(spark):
    assert u.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
