"""Url filters: host and path rules, and empirical-Bayes reputation of hosts for the rest."""

from __future__ import annotations

import hashlib
import re
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch, written
from .batches import map_rows
from .html_main import lines_of, main_lines

#: Labels that stand before a country's to make a public suffix.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: White space that the page reader folds, for the patterns of Java and Python.
FOLDED = "[\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path of a url; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, ascii_uppercase, ascii_lowercase), path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host, without user and port.

    The suffix is the last label, or the last two where a two-letter country follows one of
    SECOND_LEVEL. An address or a single label is its own domain and suffix.
    """
    bare = F.regexp_replace(host, r"^.*@|:\d*$|\.+$", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    last, second = F.try_element_at(labels, F.lit(-1)), F.try_element_at(labels, F.lit(-2))
    deep = (F.length(last) == 2) & second.isin(*SECOND_LEVEL)
    tail = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), ".")
    address = bare.rlike(r"^[0-9.]+$") | (n < 2)
    domain = F.when(address, bare).when(deep, tail(3)).otherwise(tail(2))
    return domain, F.when(address, bare).when(deep, tail(2)).otherwise(last)


def _shrunk(children: DataFrame, key: str, parents: DataFrame | None, parent: str, root: float) -> DataFrame:
    """Posterior of each child under a beta prior around its parent's mean.

    ``children``: key, parent, good, bad. The prior's strength is estimated from the level
    itself, by moments: how far the children's rates scatter around their parents' means
    beyond what their page counts explain.
    """
    if parents is None:
        known = children.withColumn("prior", F.lit(root))
    else:
        known = children.join(parents.select(F.col(parent), F.col("mean").alias("prior")), parent)
    n, p = F.col("good") + F.col("bad"), F.col("prior")
    noise = F.sum(F.when(n > 0, p * (1 - p)))
    one = known.agg(
        F.sum(F.when(n > 0, F.pow(F.col("good") / n - p, F.lit(2)) * n)).alias("spread"), noise.alias("noise"),
        F.sum(F.when(n > 0, p * (1 - p) * (n - 1))).alias("room"),
    ).first()
    rho = (one.spread - one.noise) / one.room if one.room else 0.0
    strength = 1 / min(max(rho, 0.01), 0.5) - 1
    alpha, beta = p * strength + F.col("good"), (1 - p) * strength + F.col("bad")
    return known.select(key, (alpha / (alpha + beta)).alias("mean"), (alpha + beta).alias("weight"))


def host_reputation(hosts: DataFrame, outcomes: DataFrame, least: float = 0.5, z: float = 1.645) -> DataFrame:
    """For each host: posterior ``mean`` of a good page, its upper ``bound``, and ``host_verdict``.

    ``hosts``: the hosts to judge (host). ``outcomes``: host, good, bad, in any number of rows a
    host. Rates shrink from host to registered domain to suffix to all pages. A host is
    blocked if even the upper bound (mean plus ``z`` posterior deviations) is below ``least``,
    so a host without enough bad pages is allowed; without any outcome all are.
    """
    seen = outcomes.groupBy("host").agg(F.sum("good").cast("double").alias("good"), F.sum("bad").cast("double").alias("bad"))
    domain, suffix = domain_and_suffix(F.col("host"))
    counted = written(
        hosts.select("host").union(seen.select("host")).distinct().join(seen, "host", "left")
        .na.fill(0.0, ["good", "bad"]).withColumns({"domain": domain, "suffix": suffix}), "hosts",
    )
    total = counted.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    root = ((total.good or 0) + 1) / ((total.good or 0) + (total.bad or 0) + 2)
    # Seen rates only scatter where there are outcomes; children without any just inherit.
    sums = [F.sum("good").alias("good"), F.sum("bad").alias("bad")]
    suffixes = _shrunk(counted.groupBy("suffix").agg(*sums), "suffix", None, "", root)
    domains = _shrunk(counted.groupBy("domain", "suffix").agg(*sums), "domain", suffixes, "suffix", root)
    mean, weight = F.col("mean"), F.col("weight")
    bound = mean + z * F.sqrt(mean * (1 - mean) / (weight + 1))
    return _shrunk(counted, "host", domains, "domain", root).select(
        "host", "mean", F.least(bound, F.lit(1.0)).alias("bound"), F.when(bound < least, "block").otherwise("allow").alias("host_verdict")
    )


def page_outcomes(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """host, good, bad: the quality labels of the documents that a page's article is the text of.

    Article (without its first heading) and document are compared by a digest of their
    characters without white space; a page counts once, by the mean of its labels.
    """
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("digest", T.StringType())])

    def rows(part: list[tuple]) -> list[tuple]:
        out = []
        for url, page in part:
            found = main_lines(lines_of(page)) if page else []
            body = "".join(x.text for x in (found[1:] if found and found[0].heading else found))
            if body := re.sub(FOLDED, "", body):
                out.append((url, hashlib.md5(body.encode("utf-8", "surrogatepass")).hexdigest()))
        return out

    digests = map_rows(pages, ["url", "html"], rows, schema)
    body = F.regexp_replace(docs["text"], FOLDED, "")
    texts = docs.select(docs["doc_id"].alias("doc_id"), F.when(body != "", F.md5(body.cast("binary"))).alias("digest")).where("doc_id is not null and digest is not null")
    judged = labels.where("quality in (0, 1)").groupBy(labels["doc_id"].alias("doc_id")).agg(F.avg("quality").alias("quality"))
    known = texts.join(judged, "doc_id").groupBy("digest").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    host, _ = host_and_path(F.col("url"))
    return digests.join(known, "digest").select(host.alias("host"), F.col("good"), (1 - F.col("good")).alias("bad"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule and verdict (the rule's, else the host's), with mean and bound.

    A url that is null or has no ``://`` has an empty host and path and the verdict of the
    empty host; repeated rows get equal rows. Other columns of ``pages`` are not read. Small
    jobs run while this is called, one for each level of hosts.
    """
    host, path = host_and_path(pages["url"])
    parsed = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"))
    with scratch(pages.sparkSession):
        reputation = written(host_reputation(parsed.select("host").distinct(), outcomes), "reputation", outer=True)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return parsed.join(reputation, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "host_verdict").alias("verdict"), "mean", "bound"
    )
