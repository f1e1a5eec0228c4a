import random
import re

from martflow.llm import url_filter as U
from martflow.llm.queries import QUERIES
from martflow.llm.sql import ORACLE

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(url, rules=U.SITES + U.WORDS):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = host.translate(LOWER)
    best = None
    for r in rules:
        if r.site:
            h, _, p = r.name.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.name) > len(best.name)):
                best = r
    if best:
        return host, path, best.name, best.verdict
    hit = {r.verdict for r in rules if not r.site and re.search(r.pattern, (url or "").translate(LOWER))}
    return host, path, None, "block" if hit == {"block"} else "allow"


def run(spark, urls, rules=U.SITES + U.WORDS):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judged(df, rules).collect()}


URLS = [None, "", "no scheme", "://", "http://", "http://a.NET", "http://a.net/", "http://net/x", "http://xnet/", "HTTP://Example.Net/en/1", "http://example.net/en",
        "http://www.example.net/EN/1", "http://b.example.com/de/9?x", "http://example.com/fr", "http://notexample.com/de/", "http://x.org/fr/", "http://x.org/fr",
        "http://x.org:80/fr/", "http://x.org?/fr/", "http://x.org#/fr/", "http://a.net?u=http://example.net/en/", "ftp://spam-farm.example.com/a", "http://spam-farms.com/",
        "http://a.com/casino", "http://a.com/casinos", "http://a.com/CASINO", "http://a.com/free/x/download", "http://a.com/download/free", "http://cheap-pills.com/about",
        "http://cheap-pills.com/", "http://a.com/\nfree\ndownload", "http://é.net/ü", "x" * 100_000, "http://a.com/" + "casino/" * 20_000, "a://b://c.net/", "http://a.net/"]


def test_odd_urls(spark):
    got = run(spark, URLS)
    for i, u in enumerate(URLS):
        assert got[i] == plain(u), u and u[:80]
    assert run(spark, []) == {}


def test_random_rules_and_urls(spark):
    rng = random.Random(1)
    label = lambda: rng.choice(["a", "b", "a-b", "c1", "en"])
    rules = tuple(dict.fromkeys(
        [U.site_rule(".".join(label() for _ in range(rng.randint(1, 3))) + "/" + rng.choice(["", "en", "en/", "a/b", "a/b/"]), rng.choice(["block", "allow"])) for _ in range(30)]
        + [U.word_rule(*[label() for _ in range(rng.randint(1, 2))], verdict=rng.choice(["block", "allow"])) for _ in range(8)]))
    names, kept = set(), []
    for r in rules:  # one verdict per name
        if r.name not in names:
            names.add(r.name)
            kept.append(r)
    urls = ["http://" + ".".join(label() for _ in range(rng.randint(1, 4))) + rng.choice(["", "/"]) + "/".join(label() for _ in range(rng.randint(0, 3))) + rng.choice(["", "/", "?a=b", "#c1"])
            for _ in range(300)]
    got = run(spark, urls, kept)
    same_length = lambda x: (x[0], x[1], x[2] and len(x[2]))  # noqa: E731  two rules of one length can't both fit one host and path
    for i, u in enumerate(urls):
        assert same_length(got[i]) == same_length(plain(u, kept)) and got[i][3] == plain(u, kept)[3], u


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("http://www.example.com/free/x",)] * 3 + [("http://example.com/download",)], "url string")
    filed = {r["name"]: r.token for r in U.index(urls, (U.word_rule("free", "download"), U.word_rule("example", "www"), U.word_rule("-"), U.site_rule("com/fr", "block"))).collect()}
    assert filed == {"free*download": "download", "example*www": "www", "-": "", "com/fr": "com"}


def test_no_other_rules_run(spark):
    # a rule whose pattern fits everything, filed under a token that the URL lacks, isn't run
    everything = U.Rule("all", "block", ".", ("absent",))
    assert run(spark, ["http://a.com/"], (everything,))[0][3] == "allow"


def test_repeated_rows_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "http://a.net/", "x")] * 3 + [(None, None, "y")] * 2, "page_id long, url string, rule string")
    assert sorted((r.page_id or 0, r.verdict) for r in U.judged(df).collect()) == [(0, "allow")] * 2 + [(1, "block")] * 3


def test_the_plan_is_native(spark, sf_small):
    plan = QUERIES["op10_url_filter"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_oracle(spark, sf_small):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_small}/pages.parquet'")
    names = ["page_id", "host", "path", "rule", "verdict", "pattern_rule"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE['op10_url_filter']})").fetchall()
    rows = QUERIES["op10_url_filter"](spark, sf_small).select(*names).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert {r.verdict for r in rows} == {"allow", "block"}
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == plain(urls[r.page_id])
