"""URL rules, and host reputations by empirical Bayes.

Labelled page outcomes are counted per host. Three beta-binomial priors shrink them:
suffixes towards the corpus, registered domains towards their suffix, hosts towards their
domain. How strongly a level shrinks is estimated from how much its members differ beyond
binomial noise (the moment estimate of the intraclass correlation). A host is blocked when
the lower bound of its posterior bad rate is above ``max_bad``: the beta posterior leaves less
than ``doubt`` to the rates up to ``max_bad``.

A suffix is the last label, or two where a country's registry sells names under a second one
(``co.uk``); a registered domain has one label more. Reputations leave out what stands before
``@``, a port and a dot at the end; an address of numbers is a domain of its own.

The urls are taken apart once and the counts by host written; all that follows reads those.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule
and is judged by the reputation of the empty host. A host without labelled pages has the
posterior of its domain, else of its suffix, else of the corpus; without any labelled page
the rate is 1/2 at the weakest strength. Repeated pages are judged and counted each. A very
long url is taken apart like any other. Columns beyond page_id and url are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import ascii_lower, stage

# The rules of the contract.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Pseudo-observations of a level: as estimated, but within these bounds.
WEAKEST, STRONGEST = 2.0, 10_000.0
# Second labels under which countries' registries sell names.
SECOND = ("ac", "co", "com", "edu", "go", "gob", "gov", "gv", "ltd", "me", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")
SUFFIX = rf"(?:^|\.)((?:{'|'.join(SECOND)})\.[a-z][a-z]|[^.]*)\z"
ADDRESS = r"^(?:[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|\[.*\])\z"
#: Even steps of the integral on either side of ``max_bad``; how far it reaches from the mode,
#: in standard deviations and in powers of e that the density falls by.
STEPS, DEVIATIONS, FALL = 400, 9.0, 40.0


class Filter(NamedTuple):
    """max_bad: the bad rate to be exceeded. doubt: blocked if the posterior leaves less than
    this probability to rates up to max_bad (its lower bound of 1 - doubt is above max_bad)."""

    max_bad: float = 0.15
    doubt: float = 0.05


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(found), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """The host without user, port and a dot at the end."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r"\.?(?::[0-9]*)?\z", "")


def suffix_of(name: Column) -> Column:
    return F.when(name.rlike(ADDRESS), name).otherwise(F.regexp_extract(name, SUFFIX, 1))


def domain_of(name: Column, suffix: Column) -> Column:
    """The suffix and one label more, if the name has one."""
    before = F.substring(name, F.lit(1), F.char_length(name) - F.char_length(suffix) - 1)
    return F.when(name == suffix, name).otherwise(F.concat(F.substring_index(before, ".", -1), F.lit("."), suffix))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. ``rules`` is the
    caller's short list; of equally long rules the alphabetically first wins."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, decision in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        text = F.when(fits, rule).otherwise(text)
        verdict = F.when(fits, decision).otherwise(verdict)
    return text, verdict


def _strength(level: DataFrame, mean: Column) -> float:
    """Pseudo-observations of the prior whose mean is ``mean``, by moments: n (p - m)^2 is
    expected to be m (1 - m) (1 + (n - 1) rho), and the strength is 1 / rho - 1."""
    rate, spread = F.col("bad") / F.col("n"), mean * (1 - mean)
    seen = level.filter(F.col("n") > 0).agg(
        F.sum(F.col("n") * (rate - mean) * (rate - mean) - spread).alias("excess"),
        F.sum((F.col("n") - 1) * spread).alias("room"),
    )
    row = seen.first()
    if not row["room"] or row["excess"] <= 0:
        return STRONGEST if row["room"] else WEAKEST
    return min(STRONGEST, max(WEAKEST, row["room"] / row["excess"] - 1))


def share_up_to(rate: float, a: Column, b: Column) -> Column:
    """How much of a beta distribution lies at rates up to ``rate``: Simpson's rule over the
    log odds u, where the density is exp((a + b) log s(u) - b u), s the logistic function;
    it has one peak and falls at least exponentially."""
    mode, deviation = F.log(a / b), F.sqrt((a + b) / (a * b))

    def height(u: Column) -> Column:
        return (a + b) * (F.least(u, F.lit(0.0)) - F.log(1 + F.exp(-F.abs(u)))) - b * u

    def area(low: Column, high: Column) -> Column:
        step, top = (high - low) / STEPS, height(mode)

        def add(total: Column, k: Column) -> Column:
            times = F.when((k == 0) | (k == STEPS), 1).when(k % 2 == 1, 4).otherwise(2)
            return total + times * F.exp(height(low + step * k) - top)

        return step * F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), F.lit(0.0), add)

    low, high = mode - DEVIATIONS * deviation - FALL / a, mode + DEVIATIONS * deviation + FALL / b
    middle = F.least(high, F.greatest(low, F.lit(math.log(rate / (1 - rate)))))
    below, above = area(low, middle), area(middle, high)
    return below / (below + above)


def reputations(outcomes: DataFrame, setting: Filter = Filter()) -> DataFrame:
    """From ``outcomes`` (name, n labelled pages, bad ones among them; one row per name, n may
    be 0) per name: its counts, the parameters of its posterior, its mean, and how much of the
    posterior lies at rates up to ``max_bad``. Reads ``outcomes`` several times."""
    hosts = outcomes.select("name", "n", "bad", suffix_of(F.col("name")).alias("suffix"))
    hosts = hosts.withColumn("domain", domain_of(F.col("name"), F.col("suffix")))
    # An address is its own domain, and all of them share one suffix, which no name can have.
    hosts = hosts.withColumn("suffix", F.when(F.col("name").rlike(ADDRESS), ".").otherwise(F.col("suffix")))
    summed = F.sum("n").alias("n"), F.sum("bad").alias("bad")
    domains = stage(hosts.groupBy("suffix", "domain").agg(*summed), "domains")
    suffixes = domains.groupBy("suffix").agg(*summed)
    whole = suffixes.agg(*summed).first()
    corpus = F.lit(((whole["bad"] or 0) + 1) / ((whole["n"] or 0) + 2))

    s = _strength(suffixes, corpus)
    suffixes = suffixes.select("suffix", ((F.col("bad") + s * corpus) / (F.col("n") + s)).alias("suffix_mean"))
    domains = domains.join(suffixes, "suffix")
    s = _strength(domains, F.col("suffix_mean"))
    means = domains.select("suffix", "domain", ((F.col("bad") + s * F.col("suffix_mean")) / (F.col("n") + s)).alias("domain_mean"))
    hosts = hosts.join(stage(means, "domain-means"), ["suffix", "domain"])
    s = _strength(hosts, F.col("domain_mean"))
    a, b = F.col("bad") + s * F.col("domain_mean"), F.col("n") - F.col("bad") + s * (1 - F.col("domain_mean"))
    hosts = hosts.select("name", "n", "bad", a.alias("a"), b.alias("b"), (a / (a + b)).alias("bad_rate"))
    return hosts.withColumn("below", share_up_to(setting.max_bad, F.col("a"), F.col("b")))


def taken_apart(pages: DataFrame) -> DataFrame:
    """page_id, host, path and name of every page, as a written table."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    return stage(pages.select("page_id", host.alias("host"), path.alias("path"), name_of(host).alias("name")), "urls")


def judge(
    parts: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, setting: Filter = Filter()
) -> DataFrame:
    """Per page of ``parts`` (as ``taken_apart`` gives them): page_id, host, path, rule,
    verdict, and its name's n, bad_rate and below. ``outcomes`` has page_id and bad (1 or 0), a
    row for each labelled page."""
    rule, decision = rule_of(F.col("host"), F.col("path"), rules)
    labelled = outcomes.select("page_id", F.col("bad").cast("long").alias("bad")).filter("bad is not null")
    # Counts before the join: the labels may have no row for a host, and a hot host many.
    seen = parts.join(labelled, "page_id").groupBy("name").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    known = parts.groupBy("name").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    counts = known.unionByName(seen).groupBy("name").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    rated = reputations(stage(counts, "outcomes"), setting).select("name", "n", "bad_rate", "below")
    method = F.when(F.col("below") < setting.doubt, "block").otherwise("allow")
    # Written, so that the pages of a hot name can be split over tasks.
    return parts.join(stage(rated, "reputations"), "name", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decision, method).alias("verdict"), "n", "bad_rate", "below"
    )


def labelled_pages(parts: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes of pages: a page shows the document whose id is the first number among the
    path's parts, and is bad if most of that document's labels are quality 0."""
    number = F.regexp_extract("path", r"/([0-9]{1,18})", 1)
    shown = parts.select("page_id", F.when(number != "", number).cast("long").alias("doc_id"))
    worth = labels.filter("quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    return shown.join(worth, "doc_id").select("page_id", F.when(F.col("quality") < 0.5, 1).otherwise(0).alias("bad"))
