"""Url decisions against plain Python."""

import random

import pytest

from tidemark.llm import urls
from tidemark.llm.urls import Rule

SCHEMA = "page_id long, url string, html string, host int, `a.b` string, verdict string"


def plain_split(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1].split("#")[0]
    query = "?" + rest.split("?", 1)[1] if "?" in rest else ""
    host, slash, path = rest.split("?")[0].partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return host, slash + path, host + (slash + path or "/") + query if host else None


def plain_rule(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "allow"), default=None)


def brute(rows, rules, links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    where = {}
    for a, b in links:
        (ha, pa, ka), (hb, pb, kb) = plain_split(a), plain_split(b)
        if ka and kb:
            where[ka], where[kb] = (ha, pa), (hb, pb)
            parent[find(ka)] = find(kb)
    bad = {find(k) for k, (h, p) in where.items() if (r := plain_rule(h, p, rules)) and r.verdict == "block"}
    out = []
    for page_id, url in rows:
        host, path, key = plain_split(url)
        rule = plain_rule(host, path, rules)
        alias = key in where and find(key) in bad
        verdict = rule.verdict if rule else "block" if alias else "allow"
        out.append((page_id, host, path, rule and rule.host + rule.path, verdict, "rule" if rule else "alias" if alias else "default"))
    return sorted(out, key=str)


def test_aliases_take_the_block_and_allow_has_precedence(spark):
    link = '<html><head><LINK href="{}" rel="nofollow Canonical"></head>'
    rows = [
        (1, "http://a.org/x", link.format("https://b.net/es/1?q=1#top")),       # blocked by its canonical form
        (2, "https://A.org/x#part", "<p>same resource as page 1</p>"),
        (3, "http://c.org/", '<meta content="0; URL=\'/to\'" http-equiv="Refresh">'),
        (4, "http://c.org/to", link.format("http://a.org/x")),                  # two links from the block
        (5, "http://ok.com/es/", link.format("http://a.org/x")),                # allowed by a rule, passes the block on
        (6, "http://d.org/?x", link.format("//ok.com/es/")),
        (7, "http://d.org/?y", "<!-- " + link.format("http://a.org/x") + " --><script>'" + link.format("http://a.org/x") + "'</script>"),
        (8, "http://e.org/p/q", '<base href="http://a.org/z/"><link rel=canonical href=../x>'),
        (9, "http://f.org/", link.format("http://[bad/")), (10, "http://f.org/", link.format("")),
        (11, "mailto:x", link.format("http://a.org/x")), (12, None, link.format("http://a.org/x")),
        (13, "http://g.org", None), (14, "http://g.org/", link.format("http://h.org/" + "y" * 300_000)),
        (15, "http://B.net/es/1?q=1", ""), (16, "", ""), (17, None, None), (1, "http://a.org/x", ""),
    ]
    pages = spark.createDataFrame([(*r, 1, "clash", "mine") for r in rows], SCHEMA)
    got = urls.judge(pages, urls.RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "by"]
    links = [("http://a.org/x", "https://b.net/es/1?q=1"), ("http://c.org/", "http://c.org/to"), ("http://c.org/to", "http://a.org/x"),
             ("http://ok.com/es/", "http://a.org/x"), ("http://d.org/?x", "http://ok.com/es/"), ("http://e.org/p/q", "http://a.org/x")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([r[:2] for r in rows], urls.RULES, links)
    verdicts = {r["page_id"]: (r["verdict"], r["by"]) for r in got.collect()}
    assert [i for i, v in sorted(verdicts.items()) if v == ("block", "alias")] == [1, 2, 3, 4, 6, 8]
    assert verdicts[5] == ("allow", "rule") and verdicts[15] == ("block", "rule")


def test_random_urls_and_redirects(spark):
    r = random.Random(7)
    hosts = ["example.com", "www.example.com", "Sub.Www.Example.Com", "notexample.com", "x.net", "net", "com", "a.org", "b.org:80", "u@c.org", "..", "é.org"]
    paths = ["", "/", "/en/", "/en", "/es/a", "/fr/b?c", "?q=/en/", "#/es/", "/EN/x", "//en/", "/x y\n/z", "/é"]
    many = ["http://" + r.choice(hosts) + r.choice(paths) for _ in range(300)] + ["x://y://z.net/es/", "://net/fr/", "a/b://com/"]
    rows = list(enumerate(many))
    pages = spark.createDataFrame([(i, u, None, 1, "c", "m") for i, u in rows], SCHEMA)
    links = [(r.choice(many), r.choice(many)) for _ in range(60)] + [("http://a.org/", None), (None, None)]
    redirects = spark.createDataFrame(links, "source string, target string")
    got = urls.judge(pages, urls.RULES, redirects)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute(rows, urls.RULES, links[:60])
    rules = [Rule.of("block", "b.org/"), Rule.of("allow", "b.org/"), Rule.of("block", "c.b.org"), Rule.of("allow", "org/x")]
    hard = [(1, "http://b.org/"), (2, "http://c.b.org"), (3, "http://c.b.org/x"), (4, "http://z.org/xx"), (5, "http://borg/")]
    pages = spark.createDataFrame([(i, u, None, 1, "c", "m") for i, u in hard], SCHEMA)
    assert sorted((tuple(x) for x in urls.judge(pages, rules).collect()), key=str) == brute(hard, rules, [])


def test_hot_target_and_empty_tables(spark):
    """A url that most pages point to blocks them all; no pages, links or rules give what they should."""
    rows = [(i, f"http://h{i}.org/", '<link rel="canonical" href="http://hub.net/fr/">' if i % 4 else "", 1, "c", "m") for i in range(400)]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = urls.judge(pages, urls.RULES)
    assert got.where("verdict = 'block' and by = 'alias'").count() == 300 and got.count() == 400
    assert urls.judge(pages.limit(0), urls.RULES).count() == 0
    assert urls.judge(pages, []).where("verdict = 'allow'").count() == 400
    with pytest.raises(ValueError):
        Rule("deny", "x")
