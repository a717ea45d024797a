"""URL filter: fixed rules first, then the reputation of the host.

Labelled pages are counted per host. Each level is a beta-binomial whose prior mean is the posterior mean of the level
above (host from registered domain, domain from suffix, suffix from all pages) and whose prior strength comes from the
spread of that level by the method of moments, 49 at most: where bad hosts are few among many, the moments alone would let the
prior outweigh any evidence, so the limit keeps a few dozen consistent outcomes above it at any number of hosts. A page is
blocked if the lower posterior bound of its host's share of bad pages is above ``max_bad``. Only DataFrame functions are used.

Hosts are counted once; what follows works on three small stored tables, and the driver gets one number for each level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from placefolio.llm.common import fresh
from placefolio.operators.hot_keys import join_on_unique
from placefolio.session import staged

# (rule, verdict); a rule is a host and the path from its first slash on.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block"))
MAX_BAD = 0.3
Z = 1.645
# Share of a level's variance between its groups, kept inside these limits: prior strength 49 to 1.
LEAST_SPREAD, MOST_SPREAD = 0.02, 0.5
# Suffixes of two labels under which names are registered. Pass the whole public list as a parameter.
PUBLIC_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "co.kr", "co.in",
                   "co.za", "com.br", "com.cn", "com.hk", "com.mx", "com.sg", "com.tr", "com.ar")

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """Host with A-Z lower-cased; empty for null and without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def levels_of(host: Column, public_suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, both without user part, port and final dot.

    The domain is one label more than the suffix, which is one label, or two if these are in ``public_suffixes``. An address
    of numbers is a domain and a suffix of its own, and so is a host that is no more than a suffix.
    """
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$|\.(?=:[0-9]*$)|\.$", "")
    address = name.rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*\])$")
    last = lambda n: F.regexp_extract(name, rf"([^.]+(\.[^.]+){{{n - 1}}})$", 1)
    double = last(2).isin(list(public_suffixes))
    whole = lambda found: F.when(address | (found == ""), name).otherwise(found)
    return whole(F.when(double, last(3)).otherwise(last(2))), whole(F.when(double, last(2)).otherwise(last(1)))


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, both null if none does. For policy lists of some hundred rules."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Shortest first, so that the longest ends up as the outermost condition.
    for rule, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _strength(groups: DataFrame) -> float:
    """Prior strength of a level from ``n, bad`` and the ``prior`` mean of its groups."""
    p = F.col("prior")
    row = groups.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - p, 2) / (p * (1 - p))).alias("s"),
        F.count("*").alias("k"), F.sum("n").alias("rows")).first()
    share = (row["s"] - row["k"]) / (row["rows"] - row["k"]) if row["k"] and row["rows"] > row["k"] else 0.0
    return 1 / min(max(share, LEAST_SPREAD), MOST_SPREAD) - 1


def _posterior(groups: DataFrame) -> DataFrame:
    """Add ``mean``, the posterior mean of every group, and ``strength``, the prior strength of the level."""
    strength = F.lit(_strength(groups))
    return groups.withColumns({"strength": strength,
                               "mean": (F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)})


def host_reputation(outcomes: DataFrame, max_bad: float = MAX_BAD, z: float = Z,
                    public_suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> DataFrame:
    """``host, n, bad, mean, bound, blocked`` from rows ``host, bad`` (1, 0, or null without a label).

    Every host of ``outcomes`` is in the result; hosts without labels get what their domain and suffix say. Without any label
    nothing is known: mean, bound and ``blocked`` are null.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    domain, suffix = levels_of(F.col("host"), public_suffixes)
    hosts = staged(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    count = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = staged(hosts.groupBy("domain", "suffix").agg(*count), "domains")
    suffixes = staged(domains.groupBy("suffix").agg(*count), "suffixes")
    total = suffixes.agg(*count).first()
    if not total["n"]:
        unknown = [F.lit(None).cast(kind).alias(name) for name, kind in (("mean", "double"), ("bound", "double"), ("blocked", "boolean"))]
        return hosts.select("host", "n", "bad", *unknown)
    prior_of = lambda groups, key: groups.select(key, F.col("mean").alias("prior"))
    suffixes = _posterior(suffixes.withColumn("prior", F.lit((total["bad"] + 1) / (total["n"] + 2))))
    domains = staged(_posterior(domains.join(prior_of(suffixes, "suffix"), "suffix")), "domain-means")
    # A suffix of many hosts is the key of few domains only; a domain of many hosts may be hot.
    hosts = _posterior(join_on_unique(hosts, prior_of(domains, "domain"), "domain"))
    mean = F.col("mean")
    bound = mean - z * F.sqrt(mean * (1 - mean) / (F.col("n") + F.col("strength") + 1))
    return hosts.select("host", "n", "bad", "mean", bound.alias("bound"), (bound > max_bad).alias("blocked"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
               max_bad: float = MAX_BAD, z: float = Z, url: str = "url",
               public_suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, reputation, bound`` added.

    ``outcomes`` has rows ``host, bad`` (see :func:`host_reputation`). Null urls and urls without ``://`` have an empty
    host and path and are judged as the host ``''``. Columns of ``pages`` with one of the new names are replaced.
    Repeated pages stay. No pages, no rows; no labels, every host is allowed that no rule blocks.
    """
    new = ["host", "path", "rule", "verdict", "reputation", "bound"]
    kept = [c for c in pages.columns if c.lower() not in new]
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    judged = (pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
              .withColumn("rule", rule).withColumn("verdict", verdict))
    blocked = fresh("rep_blocked", judged.columns)
    # Hosts of pages without any outcome row still get a reputation.
    seen = outcomes.select("host", F.col("bad").cast("long")).unionByName(
        judged.select("host").distinct().withColumn("bad", F.lit(None).cast("long")))
    hosts = staged(host_reputation(seen, max_bad, z, public_suffixes).select(
        F.col("host"), F.col("mean").alias("reputation"), "bound", F.col("blocked").alias(blocked)), "reputation")
    # The pages of one host may be a third of all.
    judged = join_on_unique(judged.drop("reputation", "bound"), hosts, "host", "left")
    own = F.when(F.col(blocked), "block").otherwise("allow")
    return judged.withColumn("verdict", F.coalesce("verdict", own)).select(*kept, *new)
