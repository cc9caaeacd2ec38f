"""URL filtering by rules and by redirect equivalence.

A rule blocks or allows a host, its subdomains and the paths that begin with the rule's. Pages that
no rule fits take the decision of their aliases: urls tied by redirects and canonical links, in
connected components over the whole link table. A component with a blocked url is blocked, but for the urls that
a rule allows by itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle
from tidemark.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_RULES = 10_000  # they are part of every task's plan


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str = "/"

    def __post_init__(self):
        if self.verdict not in ("allow", "block") or not self.host:
            raise ValueError("a rule allows or blocks a host")

    @classmethod
    def of(cls, verdict: str, place: str) -> Rule:
        """From ``host/path``."""
        host, slash, path = place.partition("/")
        return cls(verdict, host.translate(str.maketrans(UPPER, LOWER)), slash + path)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null or none."""
    return F.when(F.contains(url, F.lit("://")), F.substring(
        url, F.char_length(F.substring_index(url, "://", 1)) + 4, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def key_of(url: Column) -> Column:
    """What makes two urls the same resource: host, path (``/`` if empty) and query. Null for a url without a host."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(_rest(url), r"^[^?#]*([?][^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), query))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (chars, host_chars, allows, rule) of the longest rule that fits, null if none does.

    Of two rules of one length the one of the longer host wins, of equal rules that which allows.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    by_host: dict[str, list[Rule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    one = lambda r: F.struct(F.lit(len(r.host + r.path)).alias("chars"), F.lit(len(r.host)).alias("host_chars"),
                             F.lit(r.verdict == "allow").alias("allows"), F.lit(r.path).alias("path"), F.lit(r.host + r.path).alias("rule"))
    kind = "array<struct<chars:int,host_chars:int,allows:boolean,path:string,rule:string>>"
    none = F.array().cast(kind)
    if not rules:
        return F.array_max(none)
    of_host = F.create_map(*[x for h, rs in by_host.items() for x in (F.lit(h), F.array(*[one(r) for r in rs]))])
    # the last k labels of a host are a rule's host if the host is it or ends in a dot and it
    labels = sorted({h.count(".") + 1 for h in by_host})
    found = F.flatten(F.array(*[F.coalesce(F.element_at(of_host, F.substring_index(host, ".", -k)), none) for k in labels]))
    return F.array_max(F.filter(found, lambda r: path.startswith(r["path"])))


class _Links(HTMLParser):
    """Targets of canonical links and refreshes, and the base they are relative to."""

    def __init__(self):
        super().__init__()
        self.base, self.targets = None, []

    def handle_starttag(self, tag, attrs):
        a = {}
        for name, value in attrs:
            a.setdefault(name, value or "")  # the first of repeated attributes counts
        if tag == "base" and self.base is None and "href" in a:
            self.base = a["href"].strip()
        elif tag == "link" and "canonical" in a.get("rel", "").lower().split():
            self.targets.append(a.get("href", "").strip())
        elif tag == "meta" and a.get("http-equiv", "").strip().lower() == "refresh":
            _, _, to = a.get("content", "").replace(",", ";", 1).partition(";")
            name, eq, target = to.strip().partition("=")
            self.targets.append((target if eq and name.strip().lower() == "url" else to).strip().strip("'\""))


def links_of(url: str, html: str) -> list[str]:
    """Absolute urls that a page names as its canonical form or sends its reader to."""
    parser = _Links()
    parser.feed(html)
    parser.close()
    found = []
    for target in parser.targets:
        try:
            found.append(urljoin(urljoin(url, parser.base or ""), target) if target else None)
        except ValueError:  # not a url, such as an open bracket in the host
            pass
    return [t for t in dict.fromkeys(found) if t]


def _page_links(batches):
    import pyarrow as pa

    for batch in batches:
        pairs = [(u, t) for u, h in zip(batch["url"].to_pylist(), batch["html"]) for t in links_of(u, h.as_py())]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)], ["source", "target"])


def page_links(pages: DataFrame) -> DataFrame:
    """``source, target``: canonical links and refreshes in ``html``. Only pages that can have one are parsed."""
    hint = F.col("html").rlike(r"(?i)canonical|http-equiv")
    return pages.where(F.col("url").isNotNull() & hint).select("url", "html").mapInArrow(_page_links, "source string, target string")


def blocked_aliases(links: DataFrame, rules: list[Rule]) -> DataFrame:
    """``key`` of every url in a component with a blocked url.

    Urls get numbers, so that components are found on longs without a clash of hashes. Links
    to a url without a host, to itself and repeated ones tie nothing.
    """
    ends = lambda c: F.struct(key_of(F.col(c)).alias("key"), host_of(F.col(c)).alias("host"), path_of(F.col(c)).alias("path"))
    edges = settle(links.select(ends("source").alias("a"), ends("target").alias("b")).where(
        F.col("a.key").isNotNull() & F.col("b.key").isNotNull() & (F.col("a.key") != F.col("b.key"))).distinct(), "url-links")
    rule = best_rule(F.col("n.host"), F.col("n.path"), rules)
    nodes = edges.select(F.explode(F.array("a", "b")).alias("n")).select(
        "n.key", F.coalesce(~rule["allows"], F.lit(False)).alias("blocked")).distinct()
    nodes = settle(nodes.groupBy("key").agg(F.max("blocked").alias("blocked")).select(
        "key", "blocked", F.monotonically_increasing_id().alias("node")), "urls")
    numbers = nodes.select("key", "node")
    numbered = edges.select(F.col("a.key").alias("key"), F.col("b.key").alias("other")).join(numbers, "key").select(
        F.col("node").alias("u"), F.col("other").alias("key")).join(numbers, "key").select("u", F.col("node").alias("v"))
    found = settle(components(numbered, "u", "v").join(nodes, "node"), "url-components")
    bad = found.groupBy("component").agg(F.max("blocked").alias("any")).where("any").select("component")
    return found.join(bad, "component").select("key")


def judge(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, by`` for each row of ``pages`` (``page_id, url, html``).

    ``rule`` is the longest rule that fits, or null. ``by`` tells what decided: ``rule``, ``alias`` (a url
    of the page's component is blocked) or ``default`` (allow). A rule that fits the page itself has precedence,
    so an allowed page stays allowed whatever its aliases are. ``redirects`` (``source, target``) adds links to those in
    the pages. Urls are the same resource if host, path and query are equal: scheme and fragment have no part.

    A null url, or one without ``://``, has empty host and path, fits no rule and has no alias: allow.
    Null html has no links; whole urls and pages are read, however long. Repeated pages and urls are judged alike, a row each;
    an empty table gives no rows; other columns are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), key_of(F.col("url")).alias("key")).withColumn(
        "best", best_rule(F.col("host"), F.col("path"), rules))
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select("source", "target"))
    links = settle(links, "page-links")
    alias = F.lit(False)
    if not links.isEmpty():
        rows = rows.join(blocked_aliases(links, rules).withColumn("hit", F.lit(True)), "key", "left")
        alias = F.coalesce("hit", F.lit(False))
    own = F.col("best").isNotNull()
    allowed = F.when(own, F.col("best.allows")).otherwise(~alias)
    return rows.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.when(allowed, "allow").otherwise("block").alias("verdict"),
                       F.when(own, "rule").when(alias, "alias").otherwise("default").alias("by"))


#: The rules of the registered query.
RULES = [Rule.of("allow", "com/"), Rule.of("block", "example.com/en/"), Rule.of("allow", "www.example.com/en/"),
         Rule.of("block", "net/es/"), Rule.of("block", "net/fr/")]

# Links are read by pattern here, absolute ones only; aliases are what blocked urls reach.
ORACLE = f"""
with recursive rules(verdict, host, path) as (values {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}),
found as (
  select url, html, page_id from pages),
links as (
  select url as source, unnest(regexp_extract_all(html, '<link[^>]*rel="canonical"[^>]*href="([^"]*://[^"]*)"', 1)
                               || regexp_extract_all(html, '<meta[^>]*http-equiv="refresh"[^>]*url=([^"]*://[^"]*)"', 1)) as target
  from found where url is not null and html is not null),
urls as (select url from pages union select source from links union select target from links),
cut as (
  select url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from urls),
parsed as (
  select url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) as query from cut),
keyed as (select *, case when host <> '' then host || case when path = '' then '/' else path end || query end as key from parsed),
ruled as (
  select k.url, arg_max(r.host || r.path, (length(r.host || r.path), length(r.host), r.verdict = 'allow')) as rule,
         arg_max(r.verdict, (length(r.host || r.path), length(r.host), r.verdict = 'allow')) as verdict
  from keyed k join rules r on (k.host = r.host or ends_with(k.host, '.' || r.host)) and starts_with(k.path, r.path) group by k.url),
edges as (
  select distinct a.key as u, b.key as v from links l join keyed a on a.url = l.source join keyed b on b.url = l.target
  where a.key is not null and b.key is not null),
both_ways as (select u, v from edges union select v, u from edges),
reached(key) as (
  select k.key from keyed k join ruled using (url) where ruled.verdict = 'block' and k.key is not null
  union select b.v from reached join both_ways b on b.u = reached.key)
select p.page_id, coalesce(k.host, '') as host, coalesce(k.path, '') as path, r.rule,
       coalesce(r.verdict, case when k.key in (select key from reached) then 'block' else 'allow' end) as verdict,
       case when r.verdict is not null then 'rule' when k.key in (select key from reached) then 'alias' else 'default' end as "by"
from pages p left join keyed k on k.url = p.url left join ruled r on r.url = p.url
"""
