"""URL filters: parsing, given rules, mined rules."""

import pytest

from seedloom.llm import url_filter
from seedloom.llm.queries import URL_RULES
from seedloom.llm.url_filter import Mining


def judged(df, **options):
    return {
        r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
        for r in url_filter.judge(df, URL_RULES, **options).select("page_id", "judged.*").collect()
    }


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("http://A.Example.NET/en/7?x#y", "a.example.net", "/en/7", "example.net/en/"),
        ("http://example.net/en", "example.net", "/en", "net/"),
        ("http://a.net", "a.net", "", None),
        ("http://anet/", "anet", "/", None),
        ("https://example.com/de/", "example.com", "/de/", "example.com/de/"),
        ("https://notexample.com/de/", "notexample.com", "/de/", None),
        ("x://y://org/fr/1", "y:", "//org/fr/1", None),
        ("://org/fr/1", "org", "/fr/1", "org/fr/"),
        ("http://ÄÖ.org/fr/", "ÄÖ.org", "/fr/", "org/fr/"),
        ("http://a.org?q=/fr/", "a.org", "", None),
        ("http://a.org\n/fr/", "a.org\n", "/fr/", None),
        ("http://user@b.net:80/", "user@b.net:80", "/", None),
        ("no scheme/net/", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule):
    df = spark.createDataFrame([(1, url)], "page_id long, url string")
    parsed = df.select(
        url_filter.host_of(df.url).alias("h"), url_filter.path_of(df.url).alias("p"),
        url_filter.fitting_rule(url_filter.host_of(df.url), url_filter.path_of(df.url), URL_RULES).alias("r"),
    ).first()
    assert tuple(parsed) == (host, path, rule)


def test_mined_rules_decide_the_rest(spark):
    rows = [(i, f"http://s{i}.net/{'bad' if i % 2 else 'good'}/{i}") for i in range(200)]
    rows += [(200 + i, f"http://s{i}.org/fr/{i}?nice=1") for i in range(200)]
    rows += [(1000, "http://x.com/bad/7"), (1001, "http://x.com/other?nice=0"), (1002, "http://x.com/other"), (1003, None)]
    found = judged(spark.createDataFrame(rows, "page_id long, url string"))
    assert found[1][3] == "block" and found[201][3] == "allow"
    assert [found[i][3] for i in (1000, 1001, 1002, 1003)] == ["block", "allow", "allow", "allow"]
    assert {found[i][2] for i in (1000, 1001, 1002, 1003)} == {None}


def test_support_and_confidence_prune(spark):
    examples = spark.createDataFrame(
        [(["a", "b"], "block")] * 8 + [(["a"], "allow")] * 2 + [(["c"], "block")] + [(["d"], "allow")] * 89,
        "tokens array<string>, verdict string",
    )

    def mined(**options):
        rules = url_filter.mine(examples, Mining(**options)).collect()
        return {(tuple(r["tokens"]), r["verdict"], round(r["confidence"], 3)) for r in rules}

    assert mined(support=0.02, confidence=0.8) == {
        (("a",), "block", 0.8), (("b",), "block", 1.0), (("a", "b"), "block", 1.0), (("d",), "allow", 1.0)
    }
    assert mined(support=0.02, confidence=0.9) == {(("b",), "block", 1.0), (("a", "b"), "block", 1.0), (("d",), "allow", 1.0)}
    assert (("c",), "block", 1.0) in mined(support=0.01, confidence=0.8)


def test_rules_of_any_number_of_tokens(spark):
    """Five tokens together decide what no four of them do."""
    five = ["a", "b", "c", "d", "e"]
    rows = [(five, "block")] * 20 + [([t for t in five if t != left], "allow") for left in five for _ in range(30)]
    examples = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    rules = url_filter.mine(examples, Mining(support=0.05, confidence=0.8))
    sets = spark.createDataFrame([(five,), (five[:4],), ([*five, "f"],)], "tokens array<string>")
    found = {tuple(r["tokens"]): r["verdict"] for r in url_filter.match(sets, rules).collect()}
    assert {len(r["tokens"]) for r in rules.where("verdict = 'block'").collect()} <= {5}
    assert found.get(tuple(five[:4])) in (None, "allow")
    rules = url_filter.mine(examples.where("verdict = 'block' OR size(tokens) < 4"), Mining(support=0.05, confidence=0.8))
    assert max(len(r["tokens"]) for r in rules.collect()) == 5
    assert url_filter.match(sets, rules).where("tokens = array('a', 'b', 'c', 'd', 'e')").first()["verdict"] == "block"


def test_odd_rows(spark):
    rows = [(None, "http://a.net/"), (1, "http://b.net/x"), (1, "http://b.net/x"), (2, None), (3, ""), (4, "http://" + "a." * 50_000 + "net/")]
    rows = [(i, u, "x", "y", "z") for i, u in rows]
    df = spark.createDataFrame(rows, "page_id long, url string, Parsed string, TOKENS string, verdict string")
    done = url_filter.judge(df, URL_RULES)
    assert done.count() == 6 and set(df.columns) | {"judged"} == set(done.columns)
    assert [r[0] for r in done.where("verdict = 'z'").select("judged.verdict").collect()].count("block") == 4
    assert url_filter.judge(df.limit(0), URL_RULES).count() == 0


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = url_filter.judge(df, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
