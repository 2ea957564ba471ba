"""URL filter by redirect equivalence, in DataFrame operations only.

Explicit rules judge a url by host (with subdomains) and path prefix; the longest rule wins. Urls without a rule take the
decision of their aliases: the connected component over redirects, canonical links and refresh links. In a component
an explicit allow comes before any block; without either the url is allowed.

Links are all canonical and refresh tags of a page, with entities for signs decoded, seen from the page's url (a ``base`` tag is not read); nodes are
urls with scheme and host in lower case, without fragment and ``.`` or ``..`` segments.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and no alias and is allowed; null html has no
links; links to nowhere, to other things than pages (``mailto:``) and to itself are ignored; repeated pages are judged alike; an empty table gives no rows;
other columns are ignored. Of equally long rules an allow wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

#: (verdict, rule as host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TAG = r"(?i)<(?:link|meta)\b[^>]*>"
_CANONICAL, _URL, _SCHEME, _DOTS = r"(?i)(?:^|\s)canonical(?:\s|$)", r"(?i)(?:^|[;,\s])url\s*=\s*(.*)$", r"^[A-Za-z][A-Za-z0-9+.-]*:", r"/\.\.?(?:/|$)"
_QUOTES = r"""^["'\s]+|["'\s]+$"""
#: Entities that urls hold; & stands last, so that nothing is decoded twice.
ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#47;", "/"), ("&#x2F;", "/"), ("&#x2f;", "/"), ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&"))


def _value_of(name: str) -> str:
    return rf"""(?i)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host: Column, path: Column, rules=RULES) -> Column:
    """The winning rule as a struct (long, allow, rule, verdict), or null. ``rules`` is a list held in the plan: keep it to some thousands."""
    fits = []
    for verdict, text in rules:
        own, slash, tail = text.partition("/")
        fit = ((host == own) | host.endswith("." + own)) & path.startswith(slash + tail)
        fits.append(F.when(fit, F.struct(F.lit(len(text)).alias("long"), F.lit(int(verdict == "allow")).alias("allow"), F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<long:int,allow:int,rule:string,verdict:string>")


def without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    parts = F.split(F.substring(F.concat(path, F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")), 2, 1 << 30), "/")

    def step(kept: Column, part: Column) -> Column:
        return F.when(part == ".", kept).when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(part)))

    folded = F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))
    return F.when(path.rlike(_DOTS), folded).otherwise(path)


def node(url: Column) -> Column:
    """A url as a node: scheme and host in lower case, an empty path as /, no dots, no fragment."""
    plain = F.regexp_replace(url, "#.*$", "")
    scheme = F.translate(F.substring_index(plain, "://", 1), _UPPER, _LOWER)
    query = F.regexp_extract(rest(plain), r"^[^/?]*[^?]*(.*)$", 1)
    own = path(plain)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host(plain), F.when(own.startswith("/"), without_dots(own)).otherwise("/"), query))


def absolute(link: Column, url: Column) -> Column:
    """``link`` as seen from the page ``url``; null where it leads to the page itself."""
    scheme = F.substring_index(url, "://", 1)
    site, own = F.concat(scheme, F.lit("://"), host(url)), F.regexp_extract(link, r"^[^?#]*", 0)
    folder = F.regexp_replace(path(url), r"[^/]*$", "")
    beside = F.concat(site, F.when(folder == "", "/").otherwise(folder), link)
    return (
        F.when((link == "") | link.startswith("#"), None).when(link.rlike(_SCHEME), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link)).when(own == "", F.concat(site, path(url), link)).otherwise(beside)
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b): canonical and refresh links in the pages' html, between nodes."""
    tag = F.col("tag")
    value = lambda name: F.regexp_replace(F.regexp_extract(tag, _value_of(name), 1), _QUOTES, "")
    some = pages.where("url is not null and html is not null").where(F.col("html").rlike(r"(?i)canonical|refresh"))
    tags = some.select("url", F.explode(F.regexp_extract_all("html", F.lit(_TAG), F.lit(0))).alias("tag"))
    link = F.when(value("rel").rlike(_CANONICAL), value("href")).when(F.lower(value("http-equiv")) == "refresh", F.regexp_replace(F.regexp_extract(value("content"), _URL, 1), _QUOTES, ""))
    for entity, sign in ENTITIES:
        link = F.replace(link, F.lit(entity), F.lit(sign))
    links = tags.select("url", link.alias("link")).where("link != ''")
    return links.select(node(F.col("url")).alias("a"), node(absolute(F.col("link"), F.col("url"))).alias("b"))


def judge(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page (page_id, url, html); ``redirects`` (a, b) holds further pairs of urls."""
    url = F.col("url")
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b")))
    hung = components(edges)
    members = hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct())
    ruled = members.select("node", "root", rule(host(F.col("node")), path(F.col("node")), rules)["verdict"].alias("verdict"))
    decided = ruled.groupBy("root").agg(F.max(F.col("verdict") == "allow").alias("allowed"), F.max(F.col("verdict") == "block").alias("blocked")).where("blocked and not coalesce(allowed, false)")
    blocked = written(ruled.join(decided, "root").select("node", F.lit("block").alias("alias_verdict")), "blocked")
    own = pages.select("page_id", url, host(url).alias("host"), path(url).alias("path"))
    own = own.withColumn("won", rule(F.col("host"), F.col("path"), rules)).withColumn("node", F.when(F.col("won").isNull(), node(url)))
    return own.join(blocked, "node", "left").select("page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", "alias_verdict", F.lit("allow")).alias("verdict"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _node_sql(name: str, source: str, url: str) -> str:
    """CTEs that add to ``source`` the column ``name`` with the node of ``url``."""
    return f"""
{name}_1 as (select *, regexp_replace({url}, '#.*$', '') as plain from {source}),
{name}_2 as (select * exclude (plain), instr(plain, '://') > 0 as whole, translate(split_part(plain, '://', 1), '{_UPPER}', '{_LOWER}') as scheme, substr(plain, instr(plain, '://') + 3) as r from {name}_1),
{name}_3 as (select *, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as h, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as p, regexp_extract(r, '^[^/?]*[^?]*(.*)$', 1) as q from {name}_2),
{name}_4 as (select *, case when not regexp_matches(p, '{_DOTS}') then p else '/' || array_to_string(list_reduce(list_transform(string_split(substr(p || case when regexp_matches(p, '/\\.\\.?$') then '/' else '' end, 2), '/'), lambda x: [x]),
    lambda k, x: case when x[1] = '.' then k when x[1] = '..' then k[1 : greatest(len(k) - 1, 0)] else list_concat(k, x) end, []::varchar[]), '/') end as d from {name}_3),
{name}_5 as (select * exclude (whole, scheme, r, h, p, q, d), case when whole then scheme || '://' || h || case when starts_with(d, '/') then d else '/' end || q end as {name} from {name}_4)"""


def _unescaped_sql(link: str) -> str:
    for entity, sign in ENTITIES:
        link = f"replace({link}, {_quoted(entity)}, {_quoted(sign)})"
    return link


def _value_sql(name: str) -> str:
    return f"regexp_replace(regexp_extract(tag, {_quoted(_value_of(name))}, 1), {_quoted(_QUOTES)}, '', 'g')"


#: The same over ``pages`` for DuckDB.
SQL = rf"""
with recursive parts as (
  select page_id, url, html, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '') as host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from (select *, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages)
), rules(rule, own, prefix, verdict) as (
  values {", ".join(f"('{t}', '{t.partition('/')[0]}', '/{t.partition('/')[2]}', '{v}')" for v, t in RULES)}
), {_node_sql("node", "parts", "url")},
tags as (select url, host, path, node as a, unnest(regexp_extract_all(html, {_quoted(_TAG)})) as tag from node_5 where node is not null),
found as (select *, {_unescaped_sql(f"case when regexp_matches({_value_sql('rel')}, {_quoted(_CANONICAL)}) then {_value_sql('href')} when lower({_value_sql('http-equiv')}) = 'refresh' then regexp_replace(regexp_extract({_value_sql('content')}, {_quoted(_URL)}, 1), {_quoted(_QUOTES)}, '', 'g') end")} as link from tags),
seen as (select a, case when link = '' or starts_with(link, '#') then null when regexp_matches(link, '{_SCHEME}') then link when starts_with(link, '//') then split_part(url, '://', 1) || ':' || link
    when starts_with(link, '/') then site || link when starts_with(link, '?') then site || path || link else site || case when folder = '' then '/' else folder end || link end as target
  from (select *, split_part(url, '://', 1) || '://' || host as site, regexp_replace(path, '[^/]*$', '') as folder from found where link != '')
), {_node_sql("b", "seen", "target")},
edges as (select a, b from b_5 where b is not null and a != b union select b, a from b_5 where b is not null and a != b),
reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a),
judged as (
  select n, arg_max(verdict, (length(rule), verdict = 'allow')) as verdict from (select distinct b as n, regexp_extract(b, '://([^/?#]*)', 1) as h, regexp_extract(b, '://[^/?#]*([^?#]*)', 1) as p from reach) u
  join rules r on (h = r.own or ends_with(h, '.' || r.own)) and starts_with(p, r.prefix) group by n
), alias as (select r.a, case when bool_or(verdict = 'allow') then 'allow' else 'block' end as verdict from reach r join judged j on r.b = j.n group by r.a),
fits as (
  select p.page_id, p.host, p.path, p.node, r.rule, r.verdict, row_number() over (partition by p.page_id, p.url, p.html order by length(r.rule) desc nulls last, r.verdict) as n
  from (select distinct * from node_5) p left join rules r on (p.host = r.own or ends_with(p.host, '.' || r.own)) and starts_with(p.path, r.prefix)
), one as (select f.page_id, f.host, f.path, f.rule, coalesce(f.verdict, a.verdict, 'allow') as verdict from fits f left join alias a on a.a = f.node where f.n = 1)
select * from one
"""
