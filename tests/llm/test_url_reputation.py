import pytest
from compare import connect, difference, spark_answer, sql_answer
from pyspark.sql import functions as F

from rowgate.llm import url_reputation as u

SF = "/root/testdata/sf0.01"
OUTCOMES = "page_id long, is_bad boolean"


def test_query_equals_sql(spark):
    mine = spark_answer(u.op9_url_reputation(spark, SF))
    assert difference(mine, sql_answer(connect(SF), u.SQL["op9_url_reputation"])) is None


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("https://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/"),
        ("https://example.net", "example.net", "", None),
        ("https://example.net/de", "example.net", "/de", "net/"),
        ("http://badexample.com/de/1", "badexample.com", "/de/1", None),
        ("http://www.example.com/de/1", "www.example.com", "/de/1", "example.com/de/"),
        ("http://x.org?a=/fr/", "x.org", "", None),
        ("http://x.org/fr/://y.net/", "x.org", "/fr/://y.net/", "org/fr/"),
        ("http://É.net/", "É.net", "/", "net/"),
        ("no scheme", "", "", None),
        (None, "", "", None),
        ("http://", "", "", None),
        ("http://a\nb.net/c\nd#e", "a\nb.net", "/c\nd", "net/"),
        ("http://x.net/" + "p" * 100_000, "x.net", "/" + "p" * 100_000, "net/"),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule):
    row = spark.createDataFrame([(url,)], "url string").select(
        u.host_of(F.col("url")).alias("host"), u.path_of(F.col("url")).alias("path")
    )
    found = row.withColumn("rule", u.rule_for(F.col("host"), F.col("path"))).first()
    assert (found.host, found.path, found.rule) == (host, path, rule)


def test_domains_and_suffixes(spark):
    hosts = ["a.b.example.com", "example.com", "com", "x.shop.co.uk", "co.uk", ""]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").withColumn("suffix", u.suffix_of(F.col("host")))
    rows = rows.withColumn("domain", u.domain_of(F.col("host"), F.col("suffix"))).collect()
    assert [(r.domain, r.suffix) for r in rows] == [
        ("example.com", "com"), ("example.com", "com"), ("com", "com"), ("shop.co.uk", "co.uk"),
        ("co.uk", "co.uk"), ("", ""),
    ]


def test_little_evidence_is_shrunk_and_much_is_not(spark):
    rows, labels, page = [], [], 0
    for host, good, bad in (("bad.a.com", 0, 40), ("good.a.com", 60, 1), ("few.b.com", 0, 1), ("none.b.com", 0, 0)):
        for outcome in [False] * good + [True] * bad + [None] * 2:
            page += 1
            rows.append((page, f"http://{host}/"))
            labels += [(page, outcome)] * 2
    rows += [(None, "http://few.b.com/"), (1, "http://bad.a.com/"), (page + 1, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("old"))
    found = u.judged(pages, spark.createDataFrame(labels, OUTCOMES), rules=()).collect()
    assert len(found) == len(rows)
    verdict = {r.host: r.verdict for r in found}
    rate = {r.host: r.bad_rate for r in found}
    assert verdict == {"bad.a.com": "block", "good.a.com": "allow", "few.b.com": "allow", "none.b.com": "allow", "": "allow"}
    assert rate["good.a.com"] < rate["none.b.com"] < rate["few.b.com"] < rate["bad.a.com"]


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], OUTCOMES)
    assert [r.verdict for r in u.judged(pages, none).collect()] == ["allow"]
    assert u.judged(pages.limit(0), none).collect() == []


def test_no_python_in_the_plan(spark, stored):
    folder = stored(
        pages=spark.createDataFrame([(1, "http://a.com/", "")], "page_id long, url string, html string"),
        labels=spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int"),
    )
    plan = u.op9_url_reputation(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
