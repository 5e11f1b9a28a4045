import random

import pytest

from casewatch.llm import urls as U

SCHEMA = "page_id long, url string, host int"


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(r), r, v) for v, r in U.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [
    "https://WWW.Example.COM/en/1", "http://example.com/en/", "http://a.example.com/de?x=/en/", "ftp://notexample.com/en/x", "http://x.net/es/#a", "http://net/fr/1",
    "http://x.net", "http://com", "http://com/", "http://a.com?x=1", "no scheme", "", None, "http://", "http:///path", "a://b.org/c://d.com/en/", "http://x.net/fr", "http://Ü.com/é?q#f",
]


def judged(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {r["page_id"]: r for r in U.judge(frame).collect()}


def test_hosts_paths_and_rules(spark):
    got = judged(spark, [(i, u, 0) for i, u in enumerate(URLS)])
    for i, u in enumerate(URLS):
        host, path, rule, verdict = by_hand(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")


def test_trees_learn_what_rules_label(spark):
    rng = random.Random(0)
    rules = ((U.BLOCK, "bad.test/"), (U.ALLOW, "good.test/"))
    spam = lambda host: f"http://{host}/{rng.randrange(10**9)}/{rng.randrange(10**9)}?a=1&b=2&c=3"
    clean = lambda host: f"https://{host}/about/team"
    rows = [(i, spam("x.bad.test") if i % 2 else clean("x.good.test"), 0) for i in range(400)]
    rows += [(1000 + i, spam("other.org") if i % 2 else clean("other.org"), 0) for i in range(100)]
    got = {r["page_id"]: r for r in U.judge(spark.createDataFrame(rows, SCHEMA), rules).collect()}
    right = [got[1000 + i]["verdict"] == (U.BLOCK if i % 2 else U.ALLOW) for i in range(100)]
    assert sum(right) >= 95 and all(got[1000 + i]["rule"] is None for i in range(100)) and len(got) == 500


def test_empty_table_unlabelled_and_long(spark):
    assert judged(spark, []) == {}
    got = judged(spark, [(1, "http://x.org/a", 0), (2, None, 0), (2, None, 0), (3, "http://y.org/" + "a/" * 50_000, 0)])
    assert {r["verdict"] for r in got.values()} == {"allow"}


@pytest.mark.parametrize("text, bits", [("aaaa", 0.0), ("abab", 1.0), ("abcd", 2.0), ("", 0.0)])
def test_entropy(spark, text, bits):
    assert spark.createDataFrame([(text,)], "t string").select(U.entropy("t")).first()[0] == pytest.approx(bits)


def test_columns_of_any_name_are_kept(spark):
    rows = [(i, u) for i, u in enumerate(URLS)]
    names = ["found", "_kept", "label", "copies", "weight", "suffix", "fold", "n", "b", "folds"]
    frame = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", *[f"'own {c}' as `{c}`" for c in names])
    got = U.judge(frame).collect()
    assert len(got) == len(URLS) and all(r[c] == f"own {c}" for r in got for c in names)


def test_a_rare_verdict_and_a_frequent_url_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(U, "SAMPLE", 60)
    rules = ((U.BLOCK, "bad.test/"), (U.ALLOW, "good.test/"))
    rows = [(i, f"https://h{i % 300}.good.test/about/{i % 300}") for i in range(3000)] + [(9000 + i, "https://hot.good.test/") for i in range(2000)]
    rows += [(20_000 + i, f"http://bad.test/{i}7{i}?a=1&b=2") for i in range(3)]
    rows += [(30_000, "http://bid.tast/171?a=1&b=2"), (30_001, "https://h5.other.org/about/7")]
    got = {r["page_id"]: r["verdict"] for r in U.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert (got[30_000], got[30_001]) == (U.BLOCK, U.ALLOW)


def test_rates_leave_out_the_hosts_own_fold(spark):
    rows = [("a.x.org", 1.0), ("b.x.org", 0.0), ("c.x.org", 1.0)]
    labelled = spark.createDataFrame([(h, "x.org", "", label, 1.0) for h, label in rows], "host string, suffix string, segment string, label double, weight double")
    known = U.rates(labelled)
    folds = {r["host"]: r["f"] for r in labelled.select("host", U._fold().alias("f")).collect()}
    got = {r["host"]: r["suffix_rate"] for r in U.with_rates(labelled, known, out_of_fold=True).collect()}
    for h, _ in rows:
        others = [label for o, label in rows if folds[o] != folds[h]]
        assert got[h] == pytest.approx((sum(others) + U.PRIOR / 2) / (len(others) + U.PRIOR))
