"""URL filter with aliases: rules by host and path, spread over redirect classes.

Pages that redirect to each other, or name each other as canonical, are one resource.
Their addresses are joined into classes by distributed connected components; a block of
one address holds for every alias that no rule of its own speaks for, unless an allow
rule speaks for one of the class.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import materialise
from touchline.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not change what an address shows.
TRACKING = "^(?:utm_[^=]*|ref|gclid|fbclid)(?:=|$)"
CANONICAL = (
    r"(?is)<link\b(?=[^>]*\brel=[\"']?canonical[\"'\s>])[^>]*?\bhref=[\"']([^\"'<>]+)[\"']",
    r"(?is)<meta\b(?=[^>]*\bhttp-equiv=[\"']?refresh[\"'\s>])[^>]*?\bcontent=[\"'][^\"'<>]*?url=([^\"'<>;\s]+)",
)


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str  # begins with /

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lowered; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def normal_form(url: Column) -> Column:
    """One spelling of an address: without scheme, fragment, default port, leading www.
    or m., closing slashes and tracking parameters. Null without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), ":(?:80|443)$", ""), r"^(?:www|m)\.(?=[^.]+\.)", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    tail = F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), tail))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text and verdict of the longest rule that fits host and path; of equally long
    ones an allow rule comes first. The rules are part of the plan: a list of fixed size."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):
        at_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        found = F.when(at_host & F.startswith(path, F.lit(rule.path)), F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _without_dots(address: Column) -> Column:
    """A path, and what follows it, with its parts . and .. resolved."""
    path = F.regexp_extract(address, "(?s)^/([^?#]*)", 1)
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc)
        .when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, x)),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.regexp_extract(address, "(?s)^[^?#]*(.*)$", 1))


def redirects(pages: DataFrame) -> DataFrame:
    """(a, b): normal forms of each page's address and of the one it names as canonical
    or redirects to, one for every such tag. Relative addresses are taken on the page's
    host and, without a leading slash, in its folder; other schemes than :// are none."""
    html, url = F.coalesce("html", F.lit("")), F.col("url")
    raw = F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in CANONICAL])
    target = F.trim(F.col("target"))
    home, path = F.concat(F.lit("http://"), host_of(url)), path_of(url)
    folder = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(path, "^/", ""), "(?s)[^/]*$", ""))
    whole = (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(home, _without_dots(target)))
        .when(target.startswith("?"), F.concat(home, path, target))
        .when(target.startswith("#") | target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(home, _without_dots(F.concat(folder, target))))
    )
    hint = F.lower(F.coalesce("html", F.lit(""))).rlike("canonical|http-equiv")
    named = pages.where(hint).select("url", F.explode(raw).alias("target")).where("target <> ''")
    links = named.select(normal_form(F.col("url")).alias("a"), normal_form(whole).alias("b"))
    return links.where("a is not null and b is not null")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """Every row of `pages` (page_id, url, html) with host, path, rule and verdict.

    `rule` is the longest rule that fits the row's own address, else null. Its verdict
    holds. Without one, a class with a blocked and no allowed address is blocked, and
    any other has `default`. A null url, or one without ://, has empty host and path, no
    class and no rule. Other columns stay, unless they bear a result's name or one
    that begins with _own. Repeated rows are judged alike; an empty table gives none.
    """
    taken = ("host", "path", "rule", "verdict", "_own_rule", "_own_class", "_own_address")
    rows = pages.select(*[f"`{c}`" for c in pages.columns if c.lower() not in taken])
    url = F.col("url").cast("string")
    rows = rows.select("*", host_of(url).alias("host"), path_of(url).alias("path"), normal_form(url).alias("_own_address"))
    rows = rows.withColumn("_own_rule", matched_rule(F.col("host"), F.col("path"), rules))
    own = F.col("_own_rule.verdict")
    links = materialise(redirects(pages), "redirects")
    classes = connected_components(links)
    found = rows.where("_own_address is not null").select("_own_address", own.alias("v"))
    # One row per address, then per class: copies are gathered before they move.
    spoken = found.where("v is not null").groupBy("_own_address").agg(
        F.max(F.col("v") == "block").alias("blocked"), F.max(F.col("v") == "allow").alias("allowed")
    )
    of_class = F.coalesce("component", "_own_address")
    by_class = (
        spoken.join(classes, F.col("_own_address") == F.col("node"), "left")
        .groupBy(of_class.alias("_own_class")).agg(F.max("blocked").alias("blocked"), F.max("allowed").alias("allowed"))
        .where("blocked and not allowed").select("_own_class")
    )
    blocked = classes.join(by_class, F.col("component") == F.col("_own_class")).select(F.col("node").alias("_own_class"))
    blocked = materialise(blocked.union(by_class).distinct(), "blocked").withColumn("_in_blocked", F.lit(True))
    judged = rows.join(blocked, F.col("_own_address") == F.col("_own_class"), "left")
    rule = F.col("_own_rule.rule")
    verdict = F.coalesce(own, F.when(F.col("_in_blocked"), "block"), F.lit(default))
    return judged.select(*[f"`{c}`" for c in rows.columns if not c.startswith("_own")], rule.alias("rule"), verdict.alias("verdict"))
