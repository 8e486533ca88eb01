"""URL rules spread over redirect equivalence.

A rule names a host and a path prefix and allows or blocks. It fits a URL on its host or a subdomain of
it whose path starts with the rule's; of several the longest rule wins. URLs without a rule of their
own are judged by their aliases: redirects (``meta refresh``), canonical links and ``og:url`` of the
pages, and one edge from each URL to its plain form (no scheme, ``www.``, fragment, tracking parameters,
closing slash or ``.html``) join URLs to components, found with distributed minima.

Precedence: a URL's own rule always counts. An alias is blocked if a member of its component is
blocked by a rule and none is explicitly allowed by one; an explicit allow beats spread blocks.
Everything else is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarnflow.llm.common import components, release, written

A_Z, LOWER_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Parameters that don't tell pages apart.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&#]*"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, A_Z, LOWER_A_Z), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def plain(url: Column) -> Column:
    """One form for spellings of one page: ``//host/path?query``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.regexp_replace(F.regexp_replace(rest, rf"(?<=[?&]){TRACKING}(?:&|$)", ""), r"[?&]$", "")
    rest = F.regexp_replace(rest, r"(?:/+|/index\.html?|\.html?)(?=\?|$)", "")
    return F.concat(F.lit("//"), F.regexp_replace(host(url), r"^www\.", ""), rest)


def rule_of(name: Column, where: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule (ties: block), or null. ``rules`` is a short fixed list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, site, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "block")):
        fits = ((name == site) | name.endswith("." + site)) & where.startswith(start)
        rule = F.struct(F.lit(site + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, rule).otherwise(found)
    return found


#: Named character references that may stand in a URL.
REFERENCES = {
    "amp": "&", "AMP": "&", "quot": '"', "apos": "'", "lt": "<", "gt": ">", "sol": "/", "colon": ":", "period": ".",
    "quest": "?", "equals": "=", "num": "#", "lowbar": "_", "percnt": "%", "plus": "+", "comma": ",", "semi": ";",
}


def decoded(text: Column) -> Column:
    """Character references by number and by the names above as their characters, each once."""
    named = F.create_map(*[F.lit(x) for pair in REFERENCES.items() for x in pair])

    def one(token: Column) -> Column:
        inner = F.regexp_extract(token, r"^&(?:#[xX]?)?([0-9A-Za-z]+);$", 1)
        hexed = F.when(token.rlike("^&#[xX]"), F.lpad(inner, 8, "0")).otherwise(F.lpad(F.conv(inner, 10, 16), 8, "0"))
        number = token.rlike(r"^&#(?:[0-9]{1,7}|[xX]0{0,2}[0-9A-Fa-f]{1,5});$")
        return F.when(number, F.decode(F.unhex(hexed), "UTF-32")).otherwise(F.coalesce(F.try_element_at(named, inner), token))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"(&#?[0-9A-Za-z]+;|[^&]+|&)"), F.lit(1)), one), "")


def resolved(target: Column, page: Column) -> Column:
    """A target of a page as an absolute URL, by scheme, host and directory of the page's; empty if it names none."""
    scheme, site = F.regexp_extract(page, r"(?s)^([^:/?#]+):", 1), F.regexp_extract(page, r"(?s)^[^:/?#]+://([^/?#]*)", 1)
    where, query = F.regexp_extract(page, r"(?s)^[^:/?#]+://[^/?#]*([^?#]*)", 1), F.regexp_extract(page, r"(?s)^[^:/?#]+://[^/?#]*([^#]*)", 1)
    origin = F.concat(scheme, F.lit("://"), site)
    folder = F.when(where == "", "/").otherwise(F.regexp_replace(where, r"[^/]*$", ""))
    own = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.substring(target, F.length(own) + 1, F.length(target))
    # Segments "." and ".." are taken away in one pass over the path.
    steps = F.split(F.when(own.startswith("/"), own).otherwise(F.concat(folder, own)), "/")
    last = F.element_at(steps, -1)
    clean = F.aggregate(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), F.array().cast("array<string>"), lambda done, step: F.when(
        step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
    ).when(step == ".", done).otherwise(F.concat(done, F.array(step))))
    joined = F.concat(F.lit("/"), F.array_join(clean, "/"))
    joined = F.when(last.isin(".", "..") & (joined != "/"), F.concat(joined, F.lit("/"))).otherwise(joined)
    return (
        F.when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), target)
        .when((target == "") | target.rlike(r"(?i)^[a-z][a-z0-9+.-]*:") | (scheme == "") | (site == ""), "")
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(own != "", F.concat(origin, joined, rest))
        .when(target.startswith("?"), F.concat(origin, where, target))
        .otherwise(F.concat(origin, query))
    )


def links(pages: DataFrame, url: str = "url", html: str = "html", og_url: bool = False) -> DataFrame:
    """Edges ``a``, ``b`` between a page's URL and the URLs it names as its own or sends to.

    Character references in targets are decoded; relative targets are resolved against the page's URL.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    tags = F.regexp_extract_all(body, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), F.lit(1))
    tags = F.filter(tags, lambda t: t.rlike(
        r"(?is)rel\s*=\s*[\"']?\s*canonical|http-equiv\s*=\s*[\"']?\s*refresh" + r"|property\s*=\s*[\"']?\s*og:url" * og_url
    ))
    named = r"(?is)[\s\"'/](?:href|content)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
    sent = r"(?is)^[\s0-9.]*[;,\s]\s*url\s*=\s*[\"']?([^\"']*)"
    # The attribute's value, without its quotes; of a refresh what follows "url=".
    value = F.transform(tags, lambda t: F.struct(
        t.rlike(r"(?is)http-equiv\s*=\s*[\"']?\s*refresh").alias("sends"), decoded(F.regexp_replace(F.regexp_extract(t, named, 1), "^[\"']|[\"']$", "")).alias("text"),
    ))
    target = F.transform(value, lambda v: F.trim(F.when(v["sends"], F.regexp_extract(v["text"], sent, 1)).otherwise(v["text"])))
    rows = pages.select(F.col(url).alias("a"), F.explode(target).alias("target"))
    rows = rows.select("a", resolved(F.regexp_replace(F.col("target"), r"^\s+|\s+$", ""), F.col("a")).alias("b"))
    return rows.where("a is not null and b <> '' and a <> b")


def judged(
    pages: DataFrame, rules: list[tuple[str, str, str]], edges: DataFrame | None = None,
    key: str = "page_id", url: str = "url", html: str = "html", og_url: bool = False, spellings: bool = False,
) -> DataFrame:
    """One row per page: ``key``, ``host``, ``path``, ``rule`` and ``verdict``.

    ``edges`` are further pairs ``a``, ``b`` of equivalent URLs, such as a crawler's redirect log. URLs that are
    null or without ``://`` have an empty host and path, no aliases, and are allowed unless a rule
    fits. Repeated rows are judged alike; an empty table gives none; other columns are not read.
    """
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url")).withColumn("host", host(F.col("_url"))).withColumn("path", path(F.col("_url")))
    rows = rows.withColumn("_own", rule_of(F.col("host"), F.col("path"), rules))
    found = links(pages, url, html, og_url)
    if edges is not None:
        found = found.union(edges.select(F.col("a").cast("string"), F.col("b").cast("string")))
    found = written(found.where(F.col("a").contains("://") & F.col("b").contains("://")).distinct())
    if spellings:
        ends = rows.select("_url").where(F.col("_url").contains("://")).union(found.select("a")).union(found.select("b")).distinct()
        found = found.union(ends.select("_url", plain(F.col("_url"))))
    group = written(components(found))
    release(pages.sparkSession)
    # A component's fate is decided by the rules of all URLs in it, also of those no page has.
    ruled = group.withColumn("_own", rule_of(host(F.col("node")), path(F.col("node")), rules)).where("_own is not null")
    fate = ruled.groupBy("component").agg(
        F.max(F.col("_own.verdict") == "allow").alias("allowed"), F.max(F.col("_own.verdict") == "block").alias("blocked")
    ).where("blocked and not allowed").select("component")
    doomed = group.join(fate, "component").select(F.col("node").alias("_url")).distinct().withColumn("_spread", F.lit("block"))
    out = rows.join(doomed, "_url", "left")
    return out.select(
        F.col("_key").alias(key), "host", "path", F.col("_own.rule").alias("rule"),
        F.coalesce("_own.verdict", "_spread", F.lit("allow")).alias("verdict"),
    )
