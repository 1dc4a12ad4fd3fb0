"""Address rules, with block decisions carried over redirects and canonical links.

A rule (host, path, verdict) fits its host and all subdomains of it when the path of the address starts with the
rule's; the longest rule wins. Addresses without a rule take the verdict of their equivalence class: addresses joined
by redirects and canonical links are one resource, found as connected components. A class with a member that a rule
allows is allowed; otherwise a class with a member that a rule blocks is blocked; all else is allowed. An address's own
rule always comes first.

Null addresses and addresses without ``://`` have empty host and path, fit no rule and are allowed. Fragments do not
tell addresses apart. Links to or from null or blank addresses are ignored. Repeated rows are judged alike. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import prepare, stored

#: Links and refreshes in the head of a page that name its resource's other address.
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"""(?is)\brel\s*=\s*["']?\s*canonical\b"""
_REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_TARGET = r"""(?is)\burl\s*=\s*["']?\s*([^"'>;\s]+)"""


def host(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    # lower() would also change letters beyond A-Z.
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule, as host and path, and its verdict; both null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host_ == rule_host) | host_.endswith("." + rule_host)) & path_.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def _key(url: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(url, r"(?s)#.*$", "")), F.lit(""))


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst) of the canonical links and refreshes in ``pages`` (url, html); relative targets are resolved."""
    tags = pages.where("url is not null and html is not null").select("url", F.explode(F.regexp_extract_all("html", F.lit(_TAG), 0)).alias("tag"))
    href = F.concat(*(F.regexp_extract("tag", _HREF, k) for k in (1, 2, 3)))
    target = F.when(F.col("tag").rlike(_CANONICAL), href).when(F.col("tag").rlike(_REFRESH), F.regexp_extract("tag", _TARGET, 1))
    found = tags.select("url", F.trim(target).alias("to")).where("to <> ''")
    scheme = F.regexp_extract("url", r"(?s)^(.*?:)//", 1)
    site = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_extract("url", r"(?s)^.*?://[^/?#]*([^?#]*)", 1), r"[^/]*$", "")
    full = (
        F.when(F.col("to").contains("://"), F.col("to")).when(F.col("to").startswith("//"), F.concat(scheme, "to"))
        .when(F.col("to").startswith("/"), F.concat(site, "to"))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), "to"))
    )
    return found.select(F.col("url").alias("src"), full.alias("dst"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], links: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict. ``links`` has (src, dst)."""
    prepare(pages.sparkSession)
    edges = stored(
        links.select(_key(F.col("src")).alias("src"), _key(F.col("dst")).alias("dst")).where("src <> dst")
        .withColumns({"a": F.xxhash64("src"), "b": F.xxhash64("dst")}).distinct(), "links", narrow=True,
    )
    nodes = edges.select(F.col("a").alias("node"), F.col("src").alias("url")).union(edges.select("b", "dst")).distinct()
    decided = nodes.withColumn("own", rule_of(host(F.col("url")), path(F.col("url")), rules)[1])
    classes = stored(components(edges.select("a", "b")), "classes", narrow=True)
    found = (
        decided.join(classes, "node").groupBy("component")
        .agg(F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
        .where("coalesce(blocked, false) and not coalesce(allowed, false)")
    )
    blocked = stored(classes.join(found, "component").select("node").distinct(), "blocked", narrow=True)
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", F.xxhash64(_key(F.col("url"))).alias("node"), "host", "path", name.alias("rule"), verdict.alias("own"))
    inherited = F.when(F.col("hit"), "block").otherwise("allow")
    return rows.join(blocked.withColumn("hit", F.lit(True)), "node", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", inherited).alias("verdict")
    )
