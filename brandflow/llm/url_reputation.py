"""URL filter: allow and block rules, and empirical-Bayes host reputation for the rest.

Labelled page outcomes (1 bad, 0 good) are counted by host, registered domain
and suffix (the last label, or one of ``SUFFIXES``; the domain is the label before it
with the suffix; an IP address is its own domain and suffix). Each level's bad rate is shrunk towards its parent's posterior mean
through a beta prior, whose strength is estimated from how much the children of
that level differ beyond binomial noise (method of moments for the
beta-binomial): all outcomes -> suffix -> registered domain -> host. A host is
blocked when the lower bound of its posterior bad rate, ``mean - Z * sd``, is above
the threshold; hosts never seen in the labels take their domain's, suffix's or
the overall posterior. Hosts are judged once each; urls get the judgement of their
host by broadcast or, with many hosts, by a join in which large hosts are told apart.

Defined results: a null url, or one without ``://``, has empty host and path and is
judged as host "". Without any outcome every url is allowed. Outcomes are
counted once per labelled page. Port and user name are part of the host. Columns of the
urls named like an added one (host, path, domain, suffix, rule, verdict, bad_rate,
bad_bound, _rest) are replaced; others and repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from .scratch import written

#: (verdict, host, path): fits the host and its subdomains where the url's path starts with the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
Z = 1.645
THRESHOLD = 0.5
#: Prior strength lies between these many pseudo-outcomes.
WEAKEST, STRONGEST = 2.0, 10000.0
#: Public suffixes of several labels under which names are registered: a fixed extract, to be extended; others count by their last label.
SUFFIXES = tuple(
    [f"{second}.{country}" for country, seconds in {
        "uk": "co org me ltd plc net sch ac gov nhs police", "au": "com net org edu gov asn id", "nz": "co net org ac govt school geek gen maori iwi",
        "jp": "co ne or ac ad ed go gr lg", "kr": "co ne or re pe go ac", "br": "com net org gov edu art blog eco ind", "za": "co net org gov ac web law",
        "in": "co net org gen firm ind ac edu gov nic res", "cn": "com net org edu gov ac", "tw": "com net org edu gov idv", "hk": "com net org edu gov idv",
        "sg": "com net org edu gov per", "my": "com net org edu gov name", "mx": "com net org edu gob", "ar": "com net org edu gob gov int mil tur",
        "tr": "com net org edu gov web gen bel k12", "il": "co net org ac gov muni k12", "id": "co net or ac go sch web my", "th": "co net or ac go in mi",
        "ua": "com net org edu gov in", "vn": "com net org edu gov", "ph": "com net org edu gov", "pk": "com net org edu gov", "eg": "com net org edu gov",
        "pe": "com net org edu gob nom", "ec": "com net org edu gob", "ve": "co com net org edu gob web", "uy": "com net org edu gub", "co": "com net org edu gov nom",
        "pl": "com net org edu gov waw", "pt": "com org edu gov", "gr": "com net org edu gov", "cy": "com net org ac gov", "at": "co or ac gv", "hu": "co org",
        "es": "com org nom gob edu", "ke": "co or ne go ac sc", "ng": "com net org edu gov", "sa": "com net org edu gov",
    }.items() for second in seconds.split()]
    + "github.io gitlab.io blogspot.com wordpress.com herokuapp.com netlify.app vercel.app pages.dev workers.dev web.app firebaseapp.com azurewebsites.net cloudfront.net appspot.com readthedocs.io".split()
)
_IP = r"^(?:[0-9]{1,3}(?:[.][0-9]{1,3}){3}(?::[0-9]*)?|\[.*)$"
_SUFFIX = rf"(?:{'|'.join(s.replace('.', '[.]') for s in SUFFIXES)}|[^.]*)"
LEVELS = ("suffix", "domain", "host")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(urls: DataFrame) -> DataFrame:
    """``urls`` (url) with host, path, domain and suffix; domain is the suffix and the label before it, or the host if there is none."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    urls = urls.withColumn("_rest", F.coalesce(rest, F.lit("")))
    urls = urls.withColumn("host", F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), _UPPER, _LOWER))
    urls = urls.withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest")
    ip = F.col("host").rlike(_IP)
    urls = urls.withColumn("suffix", F.when(ip, F.col("host")).otherwise(F.regexp_extract("host", rf"(?:^|[.])({_SUFFIX})$", 1)))
    domain = F.regexp_extract("host", rf"([^.]+[.]{_SUFFIX[:-2]}+))$", 1)
    whole = ip | (domain == "") | (F.col("host") == F.col("suffix"))
    return urls.withColumn("domain", F.when(whole, F.col("host")).otherwise(domain))


def _counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def reputations(outcomes: DataFrame) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """Posterior (a, b) of every suffix, domain and host of ``outcomes`` (host, domain, suffix, bad), and of all outcomes."""
    counted = outcomes.withColumn("n", F.lit(1))
    hosts = written(_counts(counted, ["suffix", "domain", "host"]), "hosts")
    whole = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    top = {"a": float(whole["bad"]) + 1.0, "b": float(whole["n"] - whole["bad"]) + 1.0}
    parents: DataFrame | None = None
    out = {}
    for k, level in enumerate(LEVELS):
        rows = _counts(hosts, list(LEVELS[: k + 1]))
        if parents is None:
            rows = rows.withColumn("mean", F.lit(top["a"] / (top["a"] + top["b"])))
        else:
            rows = rows.join(parents.select(*LEVELS[:k], (F.col("a") / (F.col("a") + F.col("b"))).alias("mean")), list(LEVELS[:k]))
        rows = written(rows, level)
        spread = F.pow(F.col("bad") / F.col("n") - F.col("mean"), 2) * F.col("n") / (F.col("mean") * (1 - F.col("mean")))
        m = rows.agg(F.sum(spread).alias("z"), F.sum(F.lit(1)).alias("groups"), F.sum("n").alias("n")).first()
        excess = (m["z"] - m["groups"]) / (m["n"] - m["groups"]) if m["n"] and m["n"] > m["groups"] else 0.0
        strength = min(STRONGEST, max(WEAKEST, 1 / excess - 1)) if excess > 0 else STRONGEST
        prior_bad, prior_good = F.col("mean") * strength, (1 - F.col("mean")) * strength
        parents = written(rows.select(*LEVELS[: k + 1], (F.col("bad") + prior_bad).alias("a"), (F.col("n") - F.col("bad") + prior_good).alias("b")), level)
        out[level] = parents
        top[level] = strength
    return out, top


def lower_bound(a: Column, b: Column, z: float = Z) -> Column:
    mean = a / (a + b)
    return mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))


def rule_for(rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits (host, path), and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def judged_urls(urls: DataFrame, outcomes: DataFrame, rules=RULES, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """``urls`` (url) with host, path, rule, verdict and the posterior mean and bound of the bad rate.

    ``outcomes``: (url, bad), one row per labelled page.
    """
    tables, top = reputations(with_parts(outcomes.select("url", F.col("bad").cast("long").alias("bad"))))
    rows = with_parts(urls.drop("rule", "verdict", "bad_rate", "bad_bound"))
    a, b = F.lit(None).cast("double"), F.lit(None).cast("double")
    known = rows.select(*LEVELS).distinct()
    for level in reversed(LEVELS):  # the finest level that has outcomes
        keys = list(LEVELS[: LEVELS.index(level) + 1])
        known = known.join(tables[level].withColumnsRenamed({"a": f"a_{level}", "b": f"b_{level}"}), keys, "left")
        a, b = F.coalesce(a, F.col(f"a_{level}")), F.coalesce(b, F.col(f"b_{level}"))
    a, b = F.coalesce(a, F.lit(top["a"])), F.coalesce(b, F.lit(top["b"]))
    # one row a host; a host with a large share of the urls doesn't meet its row in a shuffle
    known = written(known.select("host", (a / (a + b)).alias("bad_rate"), lower_bound(a, b, z).alias("bad_bound")), "judged-hosts")
    rule, verdict = rule_for(rules)
    by_host = F.when(F.col("bad_bound") > threshold, "block").otherwise("allow")
    judged = lookup_join(rows, known, "host")
    return judged.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, by_host)).select(*rows.columns, "bad_rate", "bad_bound", "rule", "verdict")
