import pytest

from meterlake.llm import host_reputation as R
from tests.llm.helpers import bag, empty

PAGES = "page_id long, url string, html string, host string, verdict string"


def judged(spark, urls, outcomes=(), **options):
    rows = [(i, u, None, "mine", "mine") for i, u in enumerate(urls)]
    seen = spark.createDataFrame(list(outcomes), "host string, bad int")
    got = R.judge_urls(spark.createDataFrame(rows, PAGES), seen, **options).orderBy("page_id").collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in got]


def test_hosts_paths_and_rules(spark):
    cases = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://EXAMPLE.NET/en/x?y#z": ("example.net", "/en/x", "example.net/en/", "allow"),
        "http://a.example.net/EN/x": ("a.example.net", "/EN/x", "net/", "block"),
        "x://net": ("net", "", None, "allow"),
        "x://net/": ("net", "/", "net/", "block"),
        "http://planet/": ("planet", "/", None, "allow"),
        "http://b.example.com/de/1": ("b.example.com", "/de/1", "example.com/de/", "block"),
        "http://b.example.com/de": ("b.example.com", "/de", None, "allow"),
        "https://w.org/fr/?a=://b": ("w.org", "/fr/", "org/fr/", "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "http://h?x=/y": ("h", "", None, "allow"),
        "http://h#/y": ("h", "", None, "allow"),
        "http://ÄB.de/Ä": ("Äb.de", "/Ä", None, "allow"),
        "://": ("", "", None, "allow"),
        "http://x/\ny": ("x", "/\ny", None, "allow"),
    }
    assert judged(spark, cases) == list(cases.values())


def test_reputation_shrinks_to_the_levels_above(spark):
    outcomes = [("bad.a.com", 1)] * 60 + [("bad.a.com", 0)] * 5 + [("good.a.com", 0)] * 200 + [("one.b.com", 1)] + [("x.b.com", 0)] * 40
    got = {r.host: r for r in R.host_reputation(spark.createDataFrame(outcomes, "host string, bad int")).collect()}
    assert got["bad.a.com"].lower > 0.5 and got["one.b.com"].mean < 0.6 and got["one.b.com"].lower < 0.25
    assert got["good.a.com"].mean < 0.05 and got["good.a.com"].n == 200
    urls = ["http://bad.a.com/", "http://good.a.com/", "http://one.b.com/", "http://new.a.com/", "http://bad.a.com/"]
    assert [v for *_, v in judged(spark, urls, outcomes)] == ["block", "allow", "allow", "allow", "block"]
    # a rule goes before the reputation
    assert judged(spark, urls[:1], outcomes, rules=[("allow", "com", "/")])[0][3] == "allow"


def test_domains_and_suffixes(spark):
    hosts = ["a.b.example.com", "example.com", "com", "", "x.y.co.uk", "co.uk", "shop.example.org.au"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = df.select(R.registered_domain(df["host"]), R.public_suffix(df["host"])).collect()
    assert [tuple(r) for r in got] == [
        ("example.com", "com"), ("example.com", "com"), ("com", "com"), ("", ""), ("y.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.org.au", "org.au"),
    ]


@pytest.mark.parametrize("rows", [[], [("a.com", None)], [("a.com", 1)]])
def test_few_or_no_outcomes_block_nothing(spark, rows):
    assert judged(spark, ["http://a.com/"], rows)[0][3] == "allow"


def test_empty_and_no_python(spark):
    pages = empty(spark, PAGES)
    labels, docs_ = empty(spark, "doc_id long, quality int"), empty(spark, "doc_id long, text string")
    got = R.judge_urls(pages, R.labelled_pages(pages, docs_, labels))
    assert got.count() == 0 and bag(got.columns) == bag(["page_id", "host", "path", "rule", "verdict"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
