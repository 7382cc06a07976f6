"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes are counted per host. The rate of good pages is shrunk
through beta-binomial priors: public suffix towards all, registered domain towards
its suffix, host towards its domain. How strongly each level is shrunk is estimated
from the spread at that level. A host is blocked when even the upper bound of
its posterior stays below the limit. Rules, where they fit, go first.
"""

from __future__ import annotations

import re
from functools import partial
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_GOOD = 0.5      # a host whose rate of good pages is surely below this is blocked
BOUND_SIGMAS = 2.0
SUFFIX_STRENGTH = 20.0   # pseudo-counts that pull a suffix towards the overall rate
MOST_LABELS = 6          # no rule of the list of public suffixes has more
IP_SUFFIX = "[ip]"       # stands for the suffix of IP addresses
_IP = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")

# The rules of the query, as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def document_of(path: Column) -> Column:
    """Id of the document a page carries: the number that ends its path (``/en/12``, ``/en/12/``, ``/en/12.html``), else null."""
    return F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?\z", 1).try_cast("long")


def public_suffixes() -> frozenset[str]:
    """Rules of several labels of the Public Suffix List, in Unicode and as host names carry them (IDNA)."""
    lines = Path(__file__).with_name("public_suffixes.txt").read_text(encoding="utf-8").splitlines()
    rules = {line for line in lines if line and not line.startswith("//")}
    for rule in [r for r in rules if not r.isascii()]:
        rules.add(".".join(label if label.isascii() else "xn--" + label.encode("punycode").decode() for label in rule.split(".")))
    return frozenset(rules)


def registered(host: str, rules: frozenset[str]) -> tuple[str, str]:
    """Registered domain and public suffix of a host, without its port; an IP address is whole."""
    name = host[:host.find("]") + 1] if host.startswith("[") else host.split(":", 1)[0]
    if name.startswith("[") or _IP.fullmatch(name):
        return name, IP_SUFFIX
    labels, long = name.split("."), 1
    for n in range(min(len(labels), MOST_LABELS), 1, -1):
        if "!" + ".".join(labels[-n:]) in rules:           # an exception: the suffix is one label shorter
            long = n - 1
            break
        if ".".join(labels[-n:]) in rules or ".".join(["*", *labels[-n:][1:]]) in rules:
            long = n
            break
    return ".".join(labels[-long - 1:]), ".".join(labels[-long:])


def _with_domains(rules: frozenset[str], batches):
    for batch in batches:
        found = [registered(host, rules) for host in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([d for d, _ in found], pa.string()), pa.array([s for _, s in found], pa.string())],
            [*batch.schema.names, "domain", "suffix"])


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule (host and path) and verdict of the longest rule that fits; null if none does."""
    names, verdicts = [], []
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        names.append(F.when(fits, F.lit(rule_host + rule_path)))
        verdicts.append(F.when(fits, F.lit(verdict)))
    return F.coalesce(*names), F.coalesce(*verdicts)


def _strength(groups: DataFrame) -> float:
    """Pseudo-counts of a level's prior, by moments: groups have n, good and the prior mean m.

    With rate m and correlation r inside a group, n (good/n - m)^2 / (m (1 - m))
    is 1 + (n - 1) r on average; the prior's strength is 1/r - 1.
    """
    seen = groups.filter("n > 0 AND m > 0 AND m < 1").agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("m"), 2) / (F.col("m") * (1 - F.col("m")))).alias("s"),
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("n")).first()
    if not seen["g"] or seen["n"] <= seen["g"]:
        return SUFFIX_STRENGTH
    spread = min(max((seen["s"] - seen["g"]) / (seen["n"] - seen["g"]), 1e-3), 0.5)
    return 1 / spread - 1


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of every host: (host, n, good, mean, upper) from rows (host, good 0/1 or null).

    Null outcomes count the host but no page. An empty table gives no rows.
    Only three single-row sums come to the driver.
    """
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")) \
        .mapInArrow(partial(_with_domains, public_suffixes()), "host string, n long, good long, domain string, suffix string")
    overall = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    base = (overall["good"] + 1) / (overall["n"] + 2) if overall["n"] else 0.5
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).select(
        "suffix", ((F.col("good") + SUFFIX_STRENGTH * base) / (F.col("n") + SUFFIX_STRENGTH)).alias("m"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).join(suffixes, "suffix")
    pull = _strength(domains)
    domains = domains.select("domain", ((F.col("good") + pull * F.col("m")) / (F.col("n") + pull)).alias("m"))
    hosts = hosts.join(domains, "domain")
    pull = _strength(hosts)
    mean, weight = (F.col("good") + pull * F.col("m")) / (F.col("n") + pull), F.col("n") + pull
    return hosts.select("host", "n", "good", mean.alias("mean"),
                        (mean + BOUND_SIGMAS * F.sqrt(mean * (1 - mean) / (weight + 1))).alias("upper"))


def judge_pages(pages: DataFrame, labels: DataFrame, document: Column, rules=RULES, least_good: float = LEAST_GOOD) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The outcome of a page is the ``quality`` label of the document it carries;
    ``document`` gives its doc_id from the page's columns, null for a page without an outcome. Null
    labels are left out, several labels of one document give its pages their
    mean rounded. A null url or one without ``://`` has host and
    path empty and is judged as a host of its own. Repeated pages each count.
    Extra columns play no part.
    """
    slim = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), document.alias("doc_id"))
    known = labels.groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("good"))
    carried = slim.select("host", "doc_id")
    reputation = host_reputation(carried.join(known, "doc_id", "left").select("host", "good")) \
        .select("host", F.when(F.col("upper") < least_good, "block").otherwise("allow").alias("by_host"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    # a join on the host: one row a host on the right, so a hot host only makes its left part large, which AQE splits
    return slim.join(reputation, "host") \
        .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("by_host")).alias("verdict"))


JUDGE_SQL = f"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
p AS (SELECT *, TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})(?:\\.html)?/?$', 1) AS BIGINT) AS doc_id FROM u),
k AS (SELECT doc_id, CAST(round(avg(quality)) AS INT) AS good FROM labels GROUP BY doc_id),
h AS (
  SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good,
         array_to_string(list_slice(string_split(string_split(host, ':')[1], '.'), -2, -1), '.') AS domain,
         string_split(string_split(host, ':')[1], '.')[-1] AS suffix
  FROM p LEFT JOIN k USING (doc_id) GROUP BY host),
s AS (
  SELECT suffix, (sum(good) + {SUFFIX_STRENGTH} * base) / (sum(n) + {SUFFIX_STRENGTH}) AS m
  FROM h, (SELECT (sum(good) + 1.0) / (sum(n) + 2.0) AS base FROM h) GROUP BY suffix, base),
d AS (SELECT suffix, domain, sum(n) AS n, sum(good) AS good, any_value(m) AS m FROM h JOIN s USING (suffix) GROUP BY suffix, domain),
dk AS (
  SELECT 1 / least(greatest((sum(n * (good / n - m) ** 2 / (m * (1 - m))) - count(*)) / (sum(n) - count(*)), 1e-3), 0.5) - 1 AS pull
  FROM d WHERE n > 0),
dm AS (SELECT domain, (good + pull * m) / (n + pull) AS m FROM d, dk),
g AS (SELECT host, n, good, m FROM h JOIN dm USING (domain)),
gk AS (
  SELECT 1 / least(greatest((sum(n * (good / n - m) ** 2 / (m * (1 - m))) - count(*)) / (sum(n) - count(*)), 1e-3), 0.5) - 1 AS pull
  FROM g WHERE n > 0),
r AS (
  SELECT host, mean + {BOUND_SIGMAS} * sqrt(mean * (1 - mean) / (n + pull + 1)) AS upper
  FROM (SELECT host, n, pull, (good + pull * m) / (n + pull) AS mean FROM g, gk)),
v AS (
  SELECT page_id, host, path, upper, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p JOIN r USING (host))
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN upper < {LEAST_GOOD} THEN 'block' ELSE 'allow' END AS verdict
FROM v
"""
