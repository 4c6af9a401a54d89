"""URL rules, carried to aliases over redirect and canonical-link edges.

A page links to its canonical address (``<link rel=canonical>``) or redirects
(``<meta http-equiv=refresh>``); a table of redirects may be given as well. Pages
and targets are nodes, and connected components of these edges are the addresses
of one document. Rules decide a node by its own address; undecided pages take
the decision of their component. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.llm.common import ascii_lower, materialize
from faregrid.llm.components import connected_components

MAX_RULES = 1000

# Rules of the registered query (fixed values): verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_TAG = r"(?is)(<{0}\b[^<>]*>)"
# An attribute's value: quoted either way, or bare.
_VALUE = r"""(?is)[\s"'/]{0}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
_TARGET = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s<>]+)"""


def _attribute(tag: Column, name: str) -> Column:
    """The attribute's value without white space around it; empty if the tag has none."""
    pattern = _VALUE.format(name)
    return F.trim(F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]), F.lit(" \t\n\r\f"))


def _tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(_TAG.format(name)), F.lit(1))


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none or the url is null."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.expr("substring(_u, instr(_u, '://') + 3)")), F.lit(""))


def _split(df: DataFrame, url_col: str, prefix: str) -> DataFrame:
    """Adds {prefix}host, {prefix}path and {prefix}key (host, path and query: what an address names)."""
    rest = df.withColumn("_u", F.col(url_col)).withColumn("_r", _after_scheme(F.col("_u")))
    host = ascii_lower(F.regexp_extract("_r", r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract("_r", r"(?s)^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract("_r", r"(?s)^[^?#]*(\?[^#]*)", 1)
    out = rest.withColumn(f"{prefix}host", host).withColumn(f"{prefix}path", path)
    key = F.concat(F.col(f"{prefix}host"), F.when(F.col(f"{prefix}path") == "", "/").otherwise(F.col(f"{prefix}path")), query)
    return out.withColumn(f"{prefix}key", F.when(F.col(f"{prefix}host") != "", key)).drop("_u", "_r")


def _best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (size, allow, rule) of the longest rule that fits; of equally long ones an allow rule; else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    fits = [
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
               F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(int(v == "allow")).alias("allow"), F.lit(h + p).alias("rule")))
        for v, h, p in rules
    ]
    nothing = F.lit(None).cast("struct<size:int,allow:int,rule:string>")
    return F.array_max(F.array(*fits, nothing))


def _resolved(base_url: Column, base_host: Column, base_path: Column, target: Column) -> Column:
    t = F.replace(target, F.lit("&amp;"), F.lit("&"))
    folder = F.regexp_extract(F.when(base_path == "", "/").otherwise(base_path), r"(?s)^(.*/)", 1)
    return (
        F.when(t.isNull() | (t == ""), None)
        .when(F.instr(t, "://") > 0, t)
        .when(t.startswith("//"), F.concat(F.lit("http:"), t))
        .when(t.startswith("/"), F.concat(F.lit("http://"), base_host, t))
        .when(t.startswith("#"), None)
        .when(t.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), None)
        .when(t.startswith("?"), F.concat(F.lit("http://"), base_host, base_path, t))
        .otherwise(F.concat(F.lit("http://"), base_host, folder, t))
    )


def declared_links(pages: DataFrame) -> DataFrame:
    """(from_url, to_url): every canonical link and every redirect that a page declares outside of comments.

    A link is canonical if ``canonical`` is one of the words of its ``rel``. Targets are resolved against the first
    ``<base href>`` of the page, itself resolved against the page's address; without one against the address.
    """
    shown = _split(pages.select("url", F.regexp_replace("html", _COMMENT, " ").alias("html")), "url", "p_")
    canonical = F.filter(_tags(F.col("html"), "link"), lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical"))
    refresh = F.filter(_tags(F.col("html"), "meta"), lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    bases = F.filter(F.transform(_tags(F.col("html"), "base"), lambda t: _attribute(t, "href")), lambda h: h != "")
    found = shown.select(
        "url", "p_host", "p_path", F.get(bases, F.lit(0)).alias("base"),
        F.concat(F.transform(canonical, lambda t: _attribute(t, "href")), F.transform(refresh, lambda t: F.regexp_extract(t, _TARGET, 1))).alias("targets"),
    ).filter(F.size("targets") > 0)
    based = found.withColumn("base_url", F.coalesce(_resolved(F.col("url"), F.col("p_host"), F.col("p_path"), F.col("base")), F.col("url")))
    each = _split(based, "base_url", "s_").select("url", "s_host", "s_path", F.explode("targets").alias("target")).filter("target != ''")
    return each.select(
        F.col("url").alias("from_url"), _resolved(F.col("url"), F.col("s_host"), F.col("s_path"), F.col("target")).alias("to_url")
    )


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, reason) for every row of ``pages`` (page_id, url, html).

    The verdict is that of the page's own longest rule. Without one, it is that
    of its component: allow if any of its addresses has an allow rule (an explicit
    allow comes before a block), else block if any has a block rule, else allow.
    ``reason`` is rule, alias or default. Addresses are the same node if host,
    path and query are equal; scheme and fragment do not count. A null url, or
    one without ``://``, has an empty host and path, no rule and no aliases.
    Null html declares nothing. Repeated pages are judged each; an empty table
    gives an empty result; extra columns are ignored. At most ``MAX_RULES`` rules.
    ``redirects`` (from_url, to_url) adds edges, also of addresses without a page.
    """
    # tables between the steps keep the generated code of each small
    links = materialize(declared_links(pages), "declared-links")
    if redirects is not None:
        links = links.union(redirects.select("from_url", "to_url"))
    edges = materialize(_split(_split(links, "from_url", "a_"), "to_url", "b_").select("a_key", "b_key"), "address-links")
    members = connected_components(edges)
    ruled = _split(members.withColumn("address", F.concat(F.lit("x://"), F.col("node"))), "address", "n_").withColumn(
        "allow", _best_rule(F.col("n_host"), F.col("n_path"), rules)["allow"]
    )
    decided = ruled.groupBy("component").agg(F.max("allow").alias("alias_allow")).filter("alias_allow is not null")
    alias = members.join(decided, "component").select(F.col("node").alias("key"), "alias_allow")

    own = _split(pages.select("page_id", "url"), "url", "").withColumn("best", _best_rule(F.col("host"), F.col("path"), rules))
    allow = F.coalesce(F.col("best.allow"), F.col("alias_allow"), F.lit(1))
    return own.join(alias, "key", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.when(allow == 1, "allow").otherwise("block").alias("verdict"),
        F.when(F.col("best").isNotNull(), "rule").when(F.col("alias_allow").isNotNull(), "alias").otherwise("default").alias("reason"),
    )
