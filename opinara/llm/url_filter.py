"""URL rules whose decisions reach the aliases of a page.

A rule is a host with a path prefix, `example.org/es/`; it fits its host and all subdomains. The
longest rule that fits a url decides; of rules given twice, an allowing one. Urls without a rule
take the decision of their redirect class: the connected component over canonical links and
redirects, found by `components`. Allow has precedence: a class with an explicitly allowed url is
allowed, else one with an explicitly blocked url is blocked, else the default holds.

Edges come from the pages themselves (`<link rel=canonical>`, `<meta http-equiv=refresh>`) and
from an optional table of redirects. Urls are one node if they agree without scheme and fragment,
their host in lower case. The basic entities in link targets (`&amp;`, `&lt;`, `&gt;`, `&quot;`,
`&apos;` and their numbers) are read as the characters they stand for. Relative targets are resolved
as browsers do: `?a` keeps the page's path, `..` and `.` are carried out, `#part` alone is the page
itself. Targets of other kinds (`mailto:`, `javascript:`) are no edges. Link targets take part
whether or not they are pages themselves.

Null urls, and urls without `://`, have an empty host and path, no rule, no class and the default
verdict. Null pages hold no links. Repeated rows are judged row by row; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.components import components
from opinara.llm.salting import salted_join
from opinara.session import materialize

MAX_RULES = 1000
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"(?is)[\s\"'/]rel\s*=\s*[\"']?\s*canonical\b"
REFRESH = r"(?is)[\s\"'/]http-equiv\s*=\s*[\"']?\s*refresh\b"
#: The value of an attribute, in either kind of quotes or in none.
VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\"'\s>]+))"
HREF = r"(?is)[\s\"'/]href" + VALUE
CONTENT = r"(?is)[\s\"'/]content" + VALUE
#: What follows `url=` in the content of a refresh.
REFRESH_URL = r"(?is)\burl\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\"'].*))"
#: Characters that are no part of a target.
OUTER = r"^[\x09-\x0D ]+|[\x09-\x0D ]+$|[\t\r\n]"
#: `&` is the last, as what it leaves is no entity any more.
ENTITIES = (
    (r"&(?:lt|LT|#0*60|#[xX]0*3[cC]);", "<"),
    (r"&(?:gt|GT|#0*62|#[xX]0*3[eE]);", ">"),
    (r"&(?:quot|QUOT|#0*34|#[xX]0*22);", '"'),
    (r"&(?:apos|#0*39|#[xX]0*27);", "'"),
    (r"&(?:amp|AMP|#0*38|#[xX]0*26);", "&"),
)
ABSOLUTE = r"(?i)^[a-z][a-z0-9+.-]*://"
SCHEME = r"(?i)^[a-z][a-z0-9+.-]*:"
SITE_PATH_REST = r"(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$"
DOTS = r"/\.\.?(?:/|$)"


def host(url: Column) -> Column:
    """Host in lower case (A-Z only); empty without `://`."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 2)


def node(url: Column) -> Column:
    """The url without scheme and fragment; null without a host."""
    name = F.concat(host(url), path(url), F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 3))
    return F.when(host(url) != "", name)


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The deciding rule as a struct `size, allow, rule`, or null.

    The rules are a literal map by host, from which only the host's own suffixes are read.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules")
    by_host: dict[str, list[tuple[str, str, bool]]] = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name, []).append((slash + rest, rule, verdict == "allow"))
    if not by_host:
        return F.lit(None).cast("struct<size:int,allow:boolean,rule:string>")
    entry = lambda r: F.struct(
        F.lit(len(r[1])).alias("size"), F.lit(r[2]).alias("allow"), F.lit(r[1]).alias("rule"),
        F.lit(r[0]).alias("path"),
    )
    table = F.create_map(
        *(x for h, rs in by_host.items() for x in (F.lit(h), F.array(*map(entry, rs))))
    )
    labels = max(h.count(".") + 1 for h in by_host)
    suffixes = F.array_distinct(
        F.array(*(F.substring_index(host, ".", -n) for n in range(1, labels + 1)))
    )
    found = F.flatten(F.filter(F.transform(suffixes, lambda s: table[s]), F.isnotnull))
    fitting = F.filter(found, lambda r: F.startswith(path, r["path"]))
    return F.array_max(F.transform(fitting, lambda r: F.struct(r["size"], r["allow"], r["rule"])))


def resolved(target: Column, url: Column) -> Column:
    """A link target as an absolute url; null if it leads to no page or to the page itself."""
    site = F.concat(F.regexp_extract(url, r"(?s)^(.*?://)", 1), host(url))
    own = F.when(path(url) == "", "/").otherwise(path(url))
    folder = F.regexp_replace(own, r"[^/]*$", "")
    joined = (
        F.when((target == "") | F.startswith(target, F.lit("#")), F.lit(None))
        .when(target.rlike(ABSOLUTE), target)
        .when(target.rlike(SCHEME), F.lit(None))
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, target))
        .when(F.startswith(target, F.lit("?")), F.concat(site, own, target))
        .otherwise(F.concat(site, folder, target))
    )
    site, plain, rest = (F.regexp_extract(joined, SITE_PATH_REST, i) for i in (1, 2, 3))
    return F.when(plain.rlike(DOTS), F.concat(site, without_dots(plain), rest)).otherwise(joined)


def without_dots(path: Column) -> Column:
    """A path that starts with `/`, after its segments `.` and `..` are carried out."""
    parts = F.split(path, "/", -1)
    walked = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.lit(""),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.regexp_replace(done, r"/[^/]*$", ""))
        .otherwise(F.concat(done, F.lit("/"), part)),
    )
    return F.concat(walked, F.when(path.rlike(r"/\.\.?$"), "/").otherwise(""))


def unescaped(target: Column) -> Column:
    for entity, character in ENTITIES:
        target = F.regexp_replace(target, entity, character)
    return target


def _value(text: Column, pattern: str) -> Column:
    """What the pattern found in one of its three groups."""
    return F.concat(*(F.regexp_extract(text, pattern, i) for i in (1, 2, 3)))


def link_edges(pages: DataFrame) -> DataFrame:
    """Urls `source, target` of canonical links and refresh redirects in `url, html`."""
    tags = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(TAGS), F.lit(0))
    targets = F.transform(
        tags,
        lambda tag: F.when(tag.rlike(CANONICAL), unescaped(_value(tag, HREF))).when(
            tag.rlike(REFRESH), _value(unescaped(_value(tag, CONTENT)), REFRESH_URL)
        ),
    )
    links = pages.select("url", F.explode(targets).alias("target"))
    target = F.regexp_replace("target", OUTER, "")
    return links.select(
        F.col("url").alias("source"), resolved(target, F.col("url")).alias("target")
    ).filter("target IS NOT NULL")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    redirects: DataFrame | None = None,
    default: str = "allow",
    key: str = "page_id",
) -> DataFrame:
    """Every page's key, `host, path, rule, verdict`. Runs jobs.

    `redirects` holds urls `source, target`.
    """
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    ends = edges.select(node(F.col("source")).alias("u"), node(F.col("target")).alias("v"))
    ends = materialize(ends.filter("u <> v").distinct(), "url-edges")
    decided = best_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select(
        F.col(key), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        node(F.col("url")).alias("node"),
    ).withColumn("best", decided)
    own = F.when(F.col("best.allow"), "allow").when(~F.col("best.allow"), "block")
    if ends.isEmpty():
        classes = F.lit(None).cast("string")
    else:
        judged = salted_join(judged, _class_verdicts(ends, rules), ["node"], key)
        classes = F.col("class_verdict")
    return judged.select(
        key,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(own, classes, F.lit(default)).alias("verdict"),
    )


def _class_verdicts(ends: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """`node, class_verdict` of the nodes of edges whose class holds a decision."""
    url = F.concat(F.lit("http://"), F.col("node"))
    nodes = (
        ends.select(F.explode(F.array("u", "v")).alias("node"))
        .distinct()
        .join(components(ends), "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .withColumn("allow", best_rule(host(url), path(url), rules)["allow"])
    )
    # Booleans add up to at most one row a class, so a huge class is no hot group.
    verdicts = (
        nodes.groupBy("label")
        .agg(F.max("allow").alias("allow"))
        .filter("allow IS NOT NULL")
        .select("label", F.when(F.col("allow"), "allow").otherwise("block").alias("class_verdict"))
    )
    return salted_join(nodes.select("node", "label"), verdicts, ["label"], "node", "inner").drop(
        "label"
    )
