"""URL filter with redirect equivalence, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow.llm.common import components, cut
from dealflow.llm.line_dedup import LOWER, UPPER

#: (verdict, host, path prefix) of the contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Query parameters that never choose a page.
TRACKING = r"(?:utm_\w*|gclid|fbclid|ref)"


def with_parts(df: DataFrame, url: str) -> DataFrame:
    """``df`` with ``rest``, what follows the first ``://`` of the column ``url``; ``host``, from
    there up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; and ``path``, from the host on up
    to ``?``, ``#`` or the end. All are empty for null or without ``://``. One projection builds
    on the other, so that nothing is computed twice."""
    at = F.instr(F.col(url), "://")
    return (df.withColumn("rest", F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit("")))
            .withColumn("host", F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, LOWER))
            .withColumn("path", F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (host and path together; among equals, allow) that fits the host or a
    domain above it and a start of the path, as struct(rule, verdict); else null. ``rules`` is
    a short parameter list, one condition each."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0]))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in ordered]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def with_node(df: DataFrame, url: str) -> DataFrame:
    """``with_parts`` and ``node``, the form that all spellings of one address share: host and path
    without scheme, user, default port, fragment, tracking parameters and a slash at the end.
    Null without a host."""
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract("rest", r"^[^?#]*\?([^#]*)", 1), rf"(?:^|(?<=&)){TRACKING}(?:=[^&]*)?(?:&|$)", ""), r"&$", "")
    bare = F.regexp_replace(F.col("host"), r"^[^@]*@|:(?:80|443)$", "")
    return (with_parts(df, url).withColumn("query", query)
            .withColumn("node", F.when(F.col("host") != "", F.concat_ws("?", F.concat(bare, F.regexp_replace("path", r"/+$", "")), F.when(F.col("query") != "", F.col("query"))))))


def resolve(df: DataFrame) -> DataFrame:
    """(src, dst) of (src, ref): each link's target as seen from its page; none for a page
    without ``://``."""
    ref, scheme = F.col("ref"), F.substring_index("src", "://", 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract("rest", r"^[^/?#]*", 0))
    return with_parts(df, "src").where("ref <> '' and host <> ''").select("src", (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(site, ref))
        .otherwise(F.concat(site, F.when(F.col("path") == "", "/").otherwise(F.regexp_replace("path", r"[^/]*$", "")), ref))).alias("dst"))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst): the canonical link and the redirect that each page's markup declares."""
    page = F.col(html)
    canonical = F.regexp_extract(page, r"""(?i)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'>\s]+)""", 1)
    refresh = F.regexp_extract(page, r"""(?i)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'>\s]+)""", 1)
    found = F.array(F.when(page.rlike("(?i)canonical"), canonical), F.when(page.rlike("(?i)http-equiv"), refresh))
    return resolve(pages.select(F.col(url).alias("src"), F.explode(found).alias("ref")))


def filter_urls(pages: DataFrame, links: DataFrame, rules=RULES, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``; ``links`` (src, dst)
    are redirects and canonical links between urls.

    A url that a rule fits has the rule's verdict: an explicit allow holds whatever its
    aliases are. Any other url is blocked if a url equivalent to it is blocked by rule, else
    allowed. Equivalent are spellings of one address (``with_node``) and all addresses that
    links connect, however many lie between; a link's ends count even if no page has them.

    Only addresses with a link enter the connected components; only blocked addresses, one
    row each, meet the pages again. A null url, or one without ``://``, has empty host and
    path, no address, and so is allowed if no rule fits. Pages that repeat are judged alike.
    Other columns aren't looked at, whatever their names.
    """
    rule = rule_of(F.col("host"), F.col("path"), rules)
    page = with_node(pages.select(F.col(page_id).alias("id"), F.col(url).alias("u")), "u").withColumn("r", rule)
    ends = cut(links.select("src", "dst").where("src is not null and dst is not null"), "links")
    far = with_node(ends.select(F.explode(F.array("src", "dst")).alias("u")), "u").withColumn("r", rule)
    pair = with_node(with_node(ends, "src").select("dst", F.col("node").alias("a")), "dst").select("a", F.col("node").alias("b"))
    group = components(pair)
    blocked = (page.select("host", "node", "r").unionByName(far.select("host", "node", "r"))
               .where("host <> '' and r.verdict = 'block'").select("node").distinct())
    blocked = cut(blocked.join(group, "node", "left").select("node", "component"), "blocked-by-rule")
    alias = group.join(blocked.where("component is not null").select("component").distinct(), "component").select("node")
    bad = cut(blocked.select("node").unionByName(alias).distinct().withColumn("bad", F.lit(True)), "blocked-urls")
    return page.join(bad, "node", "left").select(
        F.col("id").alias(page_id), "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))
