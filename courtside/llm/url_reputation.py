"""URL filter by empirical-Bayes host reputation, DataFrame functions only.

Each labelled page is good or bad. Host counts are shrunk through three
beta-binomial levels: the global rate is the prior of a suffix, the suffix that
of a registered domain, the domain that of a host. The strength of each level
comes from the data (method of moments: how far the children's rates spread
beyond binomial noise). A host is blocked when the lower credible bound of its
bad rate lies above ``max_bad_rate``; hosts without evidence stay allowed.

Defined results: NULL url or one without ``://`` has empty host and path and
matches no rule; it is judged as host ''. NULL labels or ids are ignored;
repeated labels of a page count once (bad if any is); repeated pages count each.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str]  # (allow or block, "host/path")

# Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in", "com.cn", "co.za")

URL_PATTERN = "://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, URL_PATTERN, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, action) of the longest rule that fits, or NULL."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def registered_domain(host: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, without user and port."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    last2 = F.substring_index(name, ".", -2)
    two = last2.isin(*two_label)
    return (F.when(two, F.substring_index(name, ".", -3)).otherwise(last2),
            F.when(two, last2).otherwise(F.substring_index(name, ".", -1)))


def _strength(children: DataFrame, parents: DataFrame, parent: list[str]) -> Column:
    """Prior strength of a level, a scalar, from how far the children's rates spread inside their parents."""
    pooled = (F.col("pb") + 0.5) / (F.col("pn") + 1.0)
    spread = F.col("n") * F.pow(F.col("b") / F.col("n") - pooled, 2) / (pooled * (1 - pooled))
    p = parents.select(*parent, F.col("n").alias("pn"), F.col("b").alias("pb"))
    per = children.where("n > 0").join(p, parent).groupBy(*parent, "pn").agg(
        F.sum(spread).alias("s"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("n")).alias("n2"))
    tot = per.agg(F.sum("s").alias("s"), F.sum(F.col("k") - 1).alias("df"),
                  F.sum(F.col("pn") - F.col("n2") / F.col("pn")).alias("room"))
    rho = (F.col("s") - F.col("df")) / (F.col("room") - F.col("df"))
    rho = F.when((F.col("df") > 0) & (F.col("room") > F.col("df")), rho).otherwise(F.lit(0.0))
    return tot.select(1 / F.greatest(F.lit(0.005), F.least(F.lit(0.5), F.coalesce(rho, F.lit(0.0)))) - 1).scalar()


def host_reputation(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """Host counts (host, n, b) -> host, n, b, bad_rate, bad_lower, one row per host."""
    domain, suffix = registered_domain(F.col("host"))
    h = hosts.withColumns({"domain": domain, "suffix": suffix})
    sums = [F.sum("n").alias("n"), F.sum("b").alias("b")]
    d = h.groupBy("suffix", "domain").agg(*sums)
    s = d.groupBy("suffix").agg(*sums).withColumn("all", F.lit(1))
    g = s.groupBy("all").agg(*sums)

    def post(strength: Column, prior: Column) -> Column:
        return (strength * prior + F.col("b")) / (strength + F.col("n"))

    overall = g.select((F.col("b") + 0.5) / (F.col("n") + 1.0)).scalar()
    s = s.select("suffix", "n", "b", post(_strength(s, g, ["all"]), overall).alias("ps"))
    d2 = d.join(s.select("suffix", "ps"), "suffix").select(
        "suffix", "domain", post(_strength(d, s, ["suffix"]), F.col("ps")).alias("pd"))
    own = h.join(d2, ["suffix", "domain"]).withColumn("m", _strength(h, d, ["suffix", "domain"]))
    mean, weight = post(F.col("m"), F.col("pd")), F.col("m") + F.col("n")
    # Credible bound on the variance-stabilised (arcsine) scale of Beta(mean * weight, (1 - mean) * weight).
    low = F.pow(F.sin(F.greatest(F.lit(0.0), F.asin(F.sqrt(mean)) - z / (2 * F.sqrt(weight + 1)))), 2)
    return own.select("host", "n", "b", F.round(mean, 6).alias("bad_rate"), F.round(low, 6).alias("bad_lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], max_bad_rate: float = 0.5,
               z: float = 1.645, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Verdict per page. ``outcomes``: (id_col, bad 0/1), any number of rows per page.

    Returns id_col, host, path, rule, verdict, n_labelled, n_bad, bad_rate, bad_lower.
    A host with a third of all rows is one group of a partially aggregated sum, and
    its rows in the join back are split by adaptive execution.
    """
    p = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"),
                     url_path(F.col(url_col)).alias("path"))
    labelled = (outcomes.select(F.col(id_col).alias("oid"), F.col("bad").cast("int").alias("bad"))
                .where("oid IS NOT NULL AND bad IS NOT NULL").groupBy("oid").agg(F.max("bad").alias("bad")))
    counts = (p.join(labelled, F.col("id") == F.col("oid"), "left").groupBy("host")
              .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")))
    rep = host_reputation(counts, z).withColumnRenamed("host", "rep_host")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("bad_lower") > max_bad_rate, "block").otherwise("allow")
    return (p.join(rep, F.col("host") == F.col("rep_host"), "left").withColumn("hit", rule)
            .select(F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
                    F.coalesce(F.col("hit.action"), by_method).alias("verdict"),
                    F.col("n").alias("n_labelled"), F.col("b").alias("n_bad"), "bad_rate", "bad_lower"))
