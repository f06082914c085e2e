import random

from reportloom.llm import queries, url_filter
from reportloom.llm.url_filter import Rule


def brute(url, rules, otherwise="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    host = host.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
    best = None
    for r in rules:
        on_host = not r.host or host == r.host or host.endswith("." + r.host)
        on_path = path.startswith(r.path) if r.path else True
        if on_host and on_path and (best is None or (len(r.name), len(r.host), r.name) > (len(best.name), len(best.host), best.name)):
            best = r
    return host, path, best.name if best else None, best.verdict if best else otherwise


def urls():
    rng = random.Random(3)
    hosts = ["example.com", "www.Example.com", "a.b.net", "net", "xnet", "m.org", "EXAMPLE.COM:80", "u@example.com", "é.net", "www.example.com.evil.net"]
    paths = ["", "/", "/en/", "/en", "/en/1?x=/es/", "/es/2#f", "/fr/", "/EN/x", "/a.b/(c)", "?q", "#f", "/en/://x", "//en/"]
    out = [f"{rng.choice(['http', 'HTTPS', ''])}://{h}{p}" for h in hosts for p in paths]
    return [*out, None, "", "no scheme", "example.com/en/", "x://", out[0], out[0]]


def test_both_indexes_equal_brute_force(spark, monkeypatch):
    rules = [*queries.RULES, Rule("", "/a.b/", "block"), Rule("org", "", "block"), Rule("b.net", "/(c", "block"), Rule("example.com", "/en/1", "review")]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls())], "page_id long, url string, HOST string, extra string")
    want = sorted((i, *brute(u, rules)) for i, u in enumerate(urls()))
    for literal, broadcast in ((64, 1 << 20), (0, 1 << 20), (0, 0)):
        monkeypatch.setattr(url_filter, "LITERAL", literal)
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", broadcast)
        out = url_filter.judge(df, rules)
        assert out.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]
        assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()) == want, (literal, broadcast)
    assert url_filter.judge(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(df, [], otherwise="review").collect()} == {"review"}


def test_rules_stand_under_their_rarest_token(spark):
    df = spark.createDataFrame([("com", "/en/")] * 3 + [("example.com", "/x/")] * 2 + [("net", "/es/")], "host string, path string")
    found = url_filter.rarest(df, queries.RULES)
    assert found[queries.RULES[0]] == ".com" and found[queries.RULES[1]] == ".example" and found[queries.RULES[2]] == ".www" and found[queries.RULES[3]] in (".net", "/es")


def test_no_python_on_the_main_path(spark, monkeypatch):
    df = spark.createDataFrame([(1, "http://example.com/en/")], "page_id long, url string")
    for literal, broadcast in ((64, 1 << 20), (0, 1 << 20), (0, 0)):
        monkeypatch.setattr(url_filter, "LITERAL", literal)
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", broadcast)
        plan = url_filter.judge(df, queries.RULES)._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
