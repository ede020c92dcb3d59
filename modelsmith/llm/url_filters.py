"""URL filters: empirical-Bayes host reputation (operator 1).

Labelled page outcomes are counted by host, registered domain and suffix. Each
level is a beta-binomial: its groups share a prior whose mean is the posterior
mean of the level above (the suffixes' prior has the overall rate) and whose
strength is fitted to the level by the analysis-of-variance estimator of the
intra-class correlation. A host with few labels is thus drawn to its domain, a
domain to its suffix. A host is blocked if the lower posterior bound of its rate
of bad pages exceeds ``max_bad``. Explicit rules come before the reputation.

Definitions for odd rows: a null url, or one without ``://``, has an empty host
and path; the empty host is a group like any other. A label of null, or one
whose page is missing, counts nowhere. Repeated pages count once for each row.
Without any label every verdict of the method is ``allow``.

At scale: counting is a map-side combined aggregation by host, so a host with a
third of all pages sends one row from each task; the host table joins back by an
equi-join that adaptive execution splits where a host is hot. Only four numbers
a level (sums over its groups) reach the driver.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.scratch import stage

#: (verdict, rule) as the contract fixes them.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Suffixes of several labels under which names are registered: of countries, and of hosts of other people's sites.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk", "sch.uk",
    "asn.au", "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au",
    "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz", "school.nz",
    "ac.jp", "co.jp", "ed.jp", "go.jp", "gr.jp", "lg.jp", "ne.jp", "or.jp",
    "ac.kr", "co.kr", "go.kr", "or.kr", "re.kr", "ac.in", "co.in", "edu.in", "gov.in", "net.in", "org.in", "res.in",
    "ac.za", "co.za", "gov.za", "org.za", "com.br", "edu.br", "gov.br", "net.br", "org.br",
    "com.ar", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn", "com.co", "com.eg", "com.hk", "com.mx", "com.my", "com.ng", "com.pk", "com.pl",
    "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn", "ac.id", "co.id", "go.id", "ac.il", "co.il", "org.il", "ac.th", "co.th", "or.th",
    "blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "vercel.app", "web.app", "wordpress.com",
)
MAX_BAD = 0.3
Z = 1.645


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a url; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def domain_parts(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix. A suffix is the last label, or the longest listed one of several labels."""
    suffix = F.substring_index(host, ".", -1)
    domain = F.substring_index(host, ".", -2)
    for s in sorted(suffixes, key=len):
        fits = (host == s) | host.endswith(f".{s}")
        suffix = F.when(fits, F.lit(s)).otherwise(suffix)
        domain = F.when(fits, F.substring_index(host, ".", -2 - s.count("."))).otherwise(domain)
    return domain, suffix


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none fits. Of equal length the smaller string wins."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame, mean: Column) -> float:
    """Prior strength (pseudo counts) of a level by the intra-class correlation of its groups."""
    rate = F.col("bad") / F.col("n")
    x = groups.where("n > 0").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").cast("double").alias("n"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"),
        F.sum(F.col("n") * (rate - mean) * (rate - mean)).alias("between"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("within"),
    ).first()
    if not x.k or x.k < 2 or x.n <= x.k:
        return 1.0
    msb, msw = x.between / (x.k - 1), x.within / (x.n - x.k)
    size = (x.n - x.n2 / x.n) / (x.k - 1)
    spread = msb + (size - 1) * msw
    rho = (msb - msw) / spread if spread > 0 else 0.0
    rho = min(max(rho, 0.001), 0.5)
    return 1 / rho - 1


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``outcomes`` (host, domain, suffix, n, bad), one row a host -> the same with the posterior: mean, lower, upper."""
    total = outcomes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    if not total.n:
        return outcomes.select("*", F.lit(0.0).alias("mean"), F.lit(0.0).alias("lower"), F.lit(1.0).alias("upper"))
    overall = total.bad / total.n
    suffixes = outcomes.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    m = _strength(suffixes, F.lit(overall))
    suffixes = suffixes.select("suffix", ((F.col("bad") + m * overall) / (F.col("n") + m)).alias("suffix_mean"))
    domains = outcomes.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(suffixes, "suffix")
    m = _strength(domains, F.col("suffix_mean"))
    domains = domains.select("domain", ((F.col("bad") + m * F.col("suffix_mean")) / (F.col("n") + m)).alias("domain_mean"))
    hosts = outcomes.join(domains, "domain")
    m = _strength(hosts, F.col("domain_mean"))
    mean = (F.col("bad") + m * F.col("domain_mean")) / (F.col("n") + m)
    half = z * F.sqrt(mean * (1 - mean) / (F.col("n") + m + 1))
    return hosts.select(*outcomes.columns, mean.alias("mean"), F.greatest(mean - half, F.lit(0.0)).alias("lower"), F.least(mean + half, F.lit(1.0)).alias("upper"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    max_bad: float = MAX_BAD,
    z: float = Z,
    suffixes: Sequence[str] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    label_id: str = "doc_id",
    good_col: str = "quality",
) -> DataFrame:
    """Verdict on every page: page_id, host, path, rule, verdict, n_labelled, n_bad.

    ``labels`` holds outcomes by page (``good_col`` 1: good, 0: bad).
    """
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    seen = labels.where(F.col(good_col).isNotNull()).groupBy(F.col(label_id).alias("page_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col(good_col) == 0).cast("long")).alias("bad"))
    domain, suffix = domain_parts(F.col("host"), suffixes)
    outcomes = stage(
        parts.join(seen, "page_id", "left").groupBy("host").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    judged = stage(host_reputation(outcomes, z).select(
        "host", F.when(F.col("lower") > max_bad, "block").otherwise("allow").alias("by_host"), F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad")), "reputation")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return parts.join(judged, "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("by_host")).alias("verdict"), "n_labelled", "n_bad")
