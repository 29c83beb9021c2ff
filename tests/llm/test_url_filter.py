import random

from corpusloom.llm import url_filter as U

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "", "block")]


def brute(url, rules, default="allow"):
    host, path = U.split_url(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[2] if best else None, best[3] if best else default)


def test_split_url():
    assert U.split_url("http://A.b.C/x?y#z") == ("a.b.c", "/x")
    assert U.split_url("x://h?q/r") == ("h", "")
    assert U.split_url("http://É.com#/en/") == ("É.com", "")
    assert U.split_url("no scheme") == U.split_url(None) == U.split_url("") == ("", "")


def test_equals_brute_force(spark):
    rng = random.Random(1)
    hosts = ["example.com", "www.example.com", "ample.com", "com", "Example.NET", "a.example.net", "x.org", "org", "orgs", ""]
    paths = ["/en/7", "/en/70", "/en/6", "/en", "/de/8", "/de/81/x", "/de/9?x=/de/8", "", "#/en/", "/"]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)] + [None, "", "x", "://", "a://b://c"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumnRenamed("page_id", "id")
    got = {r.id: tuple(r)[1:5] for r in U.filter_urls(df, RULES, id_col="id").collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_colliding_digests_are_told_apart(tmp_path):
    same = lambda key: 42
    path = tmp_path / "index"
    path.write_bytes(U.build_index(RULES, same))
    index = U.UrlIndex(str(path), same)
    for host, url_path in [("example.com", "/en/7"), ("example.com", "/en/8"), ("x.net", "/de/8"), ("a.b", "/q"), ("x.org", "/")]:
        got = index.judge([(host.encode(), url_path.encode())])[0]
        assert (got and got[0].decode()) == brute(f"x://{host}{url_path}", RULES)[2]


def test_nulls_repeats_and_no_rules(spark, edge, nothing):
    got = U.filter_urls(edge, [], id_col="doc_id", url_col="text").collect()
    assert len(got) == 10 and all(r.verdict == "allow" and r.rule is None for r in got)
    assert U.filter_urls(nothing, RULES, id_col="doc_id", url_col="text").collect() == []
