"""URL filter by rules and empirical-Bayes host reputation. SQL functions only.

Rules are literals (verdict, host, path): a rule fits its host and all
subdomains when the url's path starts with the rule's; the longest rule wins.
Urls without a rule are judged by the reputation of their host.

Reputation. Outcomes (page, bad 0/1) are counted per host, registered domain
and public suffix. Each level shrinks towards the one above through a
beta-binomial prior: mean = the posterior mean above, strength = fitted by
moments to the spread of the rates of that level (``prior_strength``). A host
with few labelled pages thus takes the rate of its domain, one with many its
own. A host is blocked when the lower bound of its posterior bad rate (mean
minus ``z`` standard deviations, the prior counting as no more pages than are
labelled at all) is above ``max_bad``.

Counts are grouped sums (partial on the map side, so a host with a third of
all pages costs one row per task). Three scalars per level reach the driver.
The verdict of a host meets its pages in a plain join that AQE splits.

Defined results: null urls and urls without ``://`` have an empty host and
path; no rule fits an empty path. Outcomes with a null ``bad`` are ignored.
Without outcomes no host is blocked. Repeated rows each give a row.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.tables import files_for
from meterlake.scratch import checkpoint_dir

RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
# FIXED VALUES: public suffixes of two labels, by the country domain they stand in
SECOND_LEVELS = ("ac", "co", "com", "edu", "gov", "net", "org")
MAX_BAD = 0.25
Z = 1.645  # one-sided 95 %
MOST = 1000.0  # strength where the rates of a level do not differ


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")


def registered_domain(host: Column) -> Column:
    """The public suffix and one label more (the host itself if shorter)."""
    labels = F.split(host, r"\.")
    return F.array_join(F.slice(labels, -F.least(F.size(labels), suffix_labels(labels) + 1), 3), ".")


def public_suffix(host: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.array_join(F.slice(labels, -F.least(F.size(labels), suffix_labels(labels)), 2), ".")


def suffix_labels(labels: Column) -> Column:
    """Two for suffixes like ``co.uk``, else one."""
    country = F.length(F.element_at(labels, -1)) == 2
    second = F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LEVELS)
    return F.when(country & F.coalesce(second, F.lit(False)), 2).otherwise(1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ordered]
    name = F.coalesce(*[F.when(c, h + p) for c, (_, h, p) in zip(fits, ordered, strict=True)], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(c, v) for c, (v, _, _) in zip(fits, ordered, strict=True)], F.lit(None).cast("string"))
    return name, verdict


def prior_strength(counts: DataFrame) -> float:
    """Pseudo-counts of a beta prior on the rates b / n of the rows, by the
    method of moments; ``MOST`` where they differ no more than chance does."""
    n, b = F.col("n"), F.col("b")
    s = counts.agg(F.sum(n).alias("n"), F.sum(b).alias("b"), F.sum(n * n).alias("nn"), F.sum(b * b / n).alias("bb"), F.count("*").alias("k")).first()
    if not s["n"] or s["k"] < 2:
        return MOST
    mean = s["b"] / s["n"]
    spread = s["bb"] - s["n"] * mean * mean  # sum of n (rate - mean)^2
    noise, scale = (s["k"] - 1) * mean * (1 - mean), s["n"] - s["nn"] / s["n"]
    between = (spread - noise) / scale if scale > 0 else 0.0
    return MOST if between <= 0 else min(max(mean * (1 - mean) / between - 1, 1.0), MOST)


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """(host, n, b, mean, lower) from outcomes (host, bad)."""
    known = outcomes.where(F.col("bad").isNotNull())
    hosts = known.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("b"))
    checkpoint_dir(outcomes.sparkSession)
    hosts = hosts.select(
        "*", registered_domain(F.col("host")).alias("domain"), public_suffix(F.col("host")).alias("suffix")
    ).checkpoint()
    add = [F.sum("n").alias("n"), F.sum("b").alias("b")]
    domains = hosts.groupBy("domain", "suffix").agg(*add)
    suffixes = domains.groupBy("suffix").agg(*add)
    ks, kd, kh = prior_strength(suffixes), prior_strength(domains), prior_strength(hosts)
    total = suffixes.agg(*add).first()
    top = ((total["b"] or 0) + 1) / ((total["n"] or 0) + 2)

    def shrunk(prior: Column, k: float) -> Column:
        return (prior * k + F.col("b")) / (F.col("n") + k)

    s = suffixes.select("suffix", shrunk(F.lit(top), ks).alias("suffix_mean"))
    d = domains.join(s, "suffix").select("domain", shrunk(F.col("suffix_mean"), kd).alias("domain_mean"))
    h = hosts.join(d, "domain").withColumn("mean", shrunk(F.col("domain_mean"), kh))
    # the prior is never surer than all labelled pages together
    sure = min(kh, float(total["n"] or 0))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + sure + 1))
    return h.select("host", "n", "b", "mean", (F.col("mean") - z * sd).alias("lower"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    max_bad: float = MAX_BAD,
    z: float = Z,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict."""
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    bad = host_reputation(outcomes, z).where(F.col("lower") > max_bad).select("host", F.lit("block").alias("_own"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.join(bad, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "_own", F.lit("allow")).alias("verdict")
    )


# ------------------------------------------------------- outcomes of pages

LETTERS_ONLY = r"[^\p{L}\p{N}]+"


def _letters(text: Column) -> Column:
    return F.regexp_replace(text, LETTERS_ONLY, "")


def labelled_pages(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes (host, bad) of pages that carry a labelled document: the letters
    and digits of the page's article are those of the document. Documents of
    one text with different labels give none."""
    article = F.regexp_extract("html", r"(?s)<article[^>]*>(.*)</article>", 1)
    plain = F.regexp_replace(article, r"(?s)<h1.*?</h1>|<[^>]*>|&[#0-9A-Za-z]+;", "")
    shown = pages.select(url_host(F.col("url")).alias("host"), _letters(plain).alias("t"))
    quality = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q2"))
    key = [F.sha2("t", 256).alias("key")]
    known = docs.select("doc_id", _letters(F.coalesce("text", F.lit(""))).alias("t")).select("doc_id", *key).join(quality, "doc_id")
    sure = known.groupBy("key").agg(F.min("q").alias("q"), F.max("q2").alias("q2")).where("q = q2")
    return shown.where("t != ''").select("host", *key).join(sure, "key").select("host", (1 - F.col("q")).alias("bad"))
