import math
from fractions import Fraction

import pytest
from cases import result
from compare import compare
from pyspark.sql import functions as F

from starlift.llm import oracle, queries, url_filter

URLS = [
    (1, "http://WWW.Example.ORG/es/1"),
    (2, "https://example.org/en/12?x#y"),
    (3, "ftp://a.example.org"),
    (4, "http://a.com/de/1"),
    (5, "http://a.com/fr/1"),
    (6, "http://notexample.net/x"),
    (7, None),
    (8, "no scheme"),
    (9, "http://a.com?q=/de/"),
    (10, "http://x://y/de/"),
    (11, "://com/de/"),
    (12, "http://ÀÉ.com/De/"),
    (13, ""),
    (14, "http://com/fr/" + "x" * 20000),
    (15, "http://a.\nb.org/p\nq"),
    (1, "http://WWW.Example.ORG/es/1"),
    (None, "http://a.com/de/1"),
]


def pages(spark, rows=URLS):
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as path", "3 as n", "4 as bad", "5 as name")


def judge(spark, rows, outcomes):
    return url_filter.judge(url_filter.taken_apart(pages(spark, rows)), outcomes)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("#")[0].split("?")[0]
    return host, path


def rule(host, path):
    best = None
    for text, verdict in url_filter.RULES:
        name, _, start = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(text) > len(best[0])):
            best = text, verdict
    return best or (None, None)


def test_hosts_paths_and_rules(spark):
    found = judge(spark, URLS, spark.createDataFrame([], "page_id long, bad int"))
    want = []
    for page_id, url in URLS:
        host, path = split(url)
        text, verdict = rule(host, path)
        want.append((page_id, host, path, text, verdict or "allow"))
    assert sorted((tuple(r[:5]) for r in result(found)), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert result(judge(spark, [], spark.createDataFrame([], "page_id long, bad int"))) == []


def brute(counts):
    """Posterior mean and size per host, by the formulas."""
    level = {h: (n, x) for h, n, x in counts}
    up = lambda h, k: ".".join(h.split(".")[-k:])

    def summed(rows, k):
        out = {}
        for h, (n, x) in rows.items():
            a, b = out.get(up(h, k), (0, 0))
            out[up(h, k)] = a + n, b + x
        return out

    domains = summed(level, 2)
    suffixes = summed(domains, 1)
    n, x = map(sum, zip(*suffixes.values()))
    corpus = (x + 1) / (n + 2)

    def shrunk(rows, parent):
        excess = sum(n * (x / n - parent(h)) ** 2 - parent(h) * (1 - parent(h)) for h, (n, x) in rows.items() if n)
        room = sum((n - 1) * parent(h) * (1 - parent(h)) for h, (n, x) in rows.items() if n)
        s = 2.0 if not room else 10_000.0 if excess <= 0 else min(10_000.0, max(2.0, room / excess - 1))
        return {h: (x + s * parent(h)) / (n + s) for h, (n, x) in rows.items()}, s

    by_suffix, _ = shrunk(suffixes, lambda h: corpus)
    by_domain, _ = shrunk(domains, lambda h: by_suffix[up(h, 1)])
    return shrunk(level, lambda h: by_domain[up(h, 2)])


@pytest.mark.parametrize(
    "counts",
    [
        [("a.x.com", 50, 40), ("b.x.com", 3, 0), ("c.x.com", 0, 0), ("y.com", 200, 10), ("z.org", 1, 1), ("", 2, 1), ("q.z.org", 0, 0)],
        [("a.com", 0, 0), ("b.org", 0, 0)],
        [("a.com", 1, 1)],
        [("a.com", 100, 0), ("b.com", 100, 100)],
    ],
)
def test_reputations(spark, counts):
    found = url_filter.reputations(spark.createDataFrame(counts, "name string, n long, bad long"))
    want, s = brute(counts)
    for row in found.collect():
        assert row["bad_rate"] == pytest.approx(want[row["name"]])
        assert row["a"] + row["b"] == pytest.approx(row["n"] + s)


def test_share_of_a_beta_distribution(spark):
    # For whole a and b: at least a of a + b - 1 draws succeed at the given rate.
    cases = [(a, b) for a in (1, 2, 3, 10, 60, 900) for b in (1, 2, 5, 40, 700)]
    found = spark.createDataFrame([(float(a), float(b)) for a, b in cases], "a double, b double")
    for a, b, got in found.select("a", "b", url_filter.share_up_to(0.15, F.col("a"), F.col("b"))).collect():
        n, k = int(a + b) - 1, int(a)
        want = math.fsum(math.comb(n, j) * Fraction(3, 20) ** j * Fraction(17, 20) ** (n - j) for j in range(k, n + 1))
        assert got == pytest.approx(float(want), abs=1e-6)


def test_share_at_the_ends(spark):
    cases = [(1e-3, 2.0, 1.0), (2.0, 1e-6, 0.0), (1e9, 1e9, 0.0), (1.0, 1e9, 1.0), (1e9, 1.0, 0.0), (0.02, 1.98, 0.97)]
    found = spark.createDataFrame(cases, "a double, b double, want double")
    for row in found.withColumn("got", url_filter.share_up_to(0.15, F.col("a"), F.col("b"))).collect():
        assert row["got"] == pytest.approx(row["want"], abs=0.05)


@pytest.mark.parametrize(
    "host, suffix, domain",
    [
        ("a.b.co.uk", "co.uk", "b.co.uk"),
        ("b.co.uk:8080", "co.uk", "b.co.uk"),
        ("co.uk", "co.uk", "co.uk"),
        ("www.example.org.", "org", "example.org"),
        ("user:word@www.example.com:80", "com", "example.com"),
        ("xco.uk", "uk", "xco.uk"),
        ("www.xco.uk", "uk", "xco.uk"),
        ("localhost", "localhost", "localhost"),
        ("10.1.2.3:99", "10.1.2.3", "10.1.2.3"),
        ("[::1]:80", "[::1]", "[::1]"),
        ("", "", ""),
        ("a.com\n", "com\n", "a.com\n"),
    ],
)
def test_registered_domains(spark, host, suffix, domain):
    name = url_filter.name_of(F.lit(host))
    found = spark.range(1).select(name.alias("n")).select(url_filter.suffix_of(F.col("n")).alias("s"), "n").select("s", url_filter.domain_of(F.col("n"), F.col("s")))
    assert tuple(found.first()) == (suffix, domain)


def test_ports_share_a_reputation(spark):
    rows = [(k, f"http://bad.co.uk:{k % 3}/p") for k in range(60)] + [(k, f"http://good{k % 30}.co.uk/p") for k in range(100, 700)] + [(999, "http://u@bad.co.uk/p")]
    outcomes = spark.range(0, 700).select(F.col("id").alias("page_id"), F.when(F.col("id") < 55, 1).otherwise(0).alias("bad"))
    found = {r["host"]: r["verdict"] for r in judge(spark, rows, outcomes).collect()}
    assert {host for host, verdict in found.items() if verdict == "block"} == {"bad.co.uk:0", "bad.co.uk:1", "bad.co.uk:2", "u@bad.co.uk"}


def test_a_bad_host_is_blocked_and_a_little_seen_one_is_not(spark):
    rows = [(k, "http://bad.x.net/p") for k in range(60)] + [(k, f"http://h{k % 30}.net/p") for k in range(100, 700)] + [(999, "http://new.net/p")]
    outcomes = spark.range(0, 1000).select(F.col("id").alias("page_id"), F.when(F.col("id") < 55, 1).otherwise(0).alias("bad")).filter("page_id <> 999")
    found = {(r["host"], r["verdict"]) for r in judge(spark, rows, outcomes).collect()}
    assert ("bad.x.net", "block") in found and ("new.net", "allow") in found and len(found) == 32


def test_query_equals_sql(spark, sf_dir, tables):
    assert compare(queries.op3_url_filter(spark, sf_dir), tables, oracle.oracle()["op3_url_filter"]) is None
