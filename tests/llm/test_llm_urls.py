"""URL rules and vocabulary against a plain reading of them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from saldo.llm.catalog import QUERIES, URL_RULES
from saldo.llm.urlfilter import SOFT, STRICT, Rules, Terms, Vocabulary, judge_urls

ROW = "page_id long, url string"


def plain(url, rules, vocabulary):
    """host, path, rule, verdict, strict terms and distinct soft terms, by regular expressions."""
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = []
    for verdict, text in rules:
        rule_host, slash, rest = text.partition("/")
        if f".{host}".endswith(f".{rule_host}") and path.startswith(slash + rest):
            fitting.append((len(text), len(rule_host), text, verdict))
    text = (host + path).lower()

    def count(spelling):
        places = [m.start() for m in re.finditer(f"(?={re.escape(spelling)})", text)]
        return sum(
            not (p and text[p - 1].isalpha()) and not text[p + len(spelling) : p + len(spelling) + 1].isalpha()
            for p in places
        )

    strict = sorted(s for s in vocabulary.strict for _ in range(count(s)))
    soft = sorted(t for t, spelled in vocabulary.soft.items() if any(map(count, spelled)))
    blocks = strict or sum(vocabulary.weights.get(t, 1) for t in soft) >= vocabulary.limit
    rule, verdict = max(fitting)[2:] if fitting else (None, "block" if blocks else "allow")
    return host, path, rule, verdict, strict, soft


CASES = [
    None, "", "casino.com/xxx", "http://", "http:///casino", "HTTP://WWW.Example.ORG/es/1", "http://example.org/en/12",
    "http://example.org/en/2", "http://notexample.org/es/", "http://org/", "http://org", "http://a.com/fr/casino",
    "http://a.com/de/", "http://a.com/DE/", "http://casino777.net/", "http://casinoroyale.net/", "http://essex.net/sex",
    "http://free.net/free/free", "http://free-bets.net/", "http://bet-bets-betting.net/", "http://ads.net?x=casino",
    "http://ads.net#track", "http://ads.net/track", "x://y://casino.net/", "http://a.net/\nporn\n", "http://.com/fr/",
    "http://" + "a." * 5000 + "com/de/" + "b" * 50_000, "http://a.net/" + "free/" * 20_000, "http://a.net/ПОРНО/éxxxé",
    "http://user@a.com:80/fr/", "http://a.org", "http://xxx-xxx.net/xxx", "http://a.net/x-rated/x",
]


def test_urls_equal_plain_reading(spark):
    pick = random.Random(5)
    pieces = [*STRICT, *sum(SOFT.values(), []), "the", "on", "7", "-", ".", "/", "é"]
    urls = CASES + [
        f"http://{''.join(pick.choices(pieces, k=4))}.{pick.choice(['com', 'example.org', 'net'])}"
        f"/{pick.choice(['en', 'de', 'fr', 'es'])}/{pick.choice(['1', '2', ''])}{''.join(pick.choices(pieces, k=3))}"
        for _ in range(800)
    ]
    frame = spark.createDataFrame(list(enumerate(urls)), ROW).withColumn("Verdict", F.lit("clash"))
    rows = judge_urls(frame.unionByName(frame.limit(3)), URL_RULES).collect()
    assert len(rows) == len(urls) + 3
    for r in rows:
        found = (r.host, r.path, r.rule, r.verdict, r.strict_terms, r.soft_terms)
        assert found == plain(urls[r.page_id], URL_RULES, Vocabulary()), urls[r.page_id]
    assert {r.verdict for r in rows if r.rule is None} == {"allow", "block"}
    empty = judge_urls(spark.createDataFrame([], ROW), URL_RULES)
    assert empty.count() == 0 and empty.columns == ["page_id", "url", "path", "host", "rule", "verdict",
                                                     "strict_terms", "soft_terms", "soft_weight"]


def test_columns_and_other_vocabularies(spark):
    frame = spark.createDataFrame([(1, "http://a.net/%66oo/bar", "h"), (1, "http://a.net/baz", None)],
                                  "id long, link string, host string")
    light = Vocabulary(strict=["Baz"], soft={"foo": ["foo"], "bar": ["bar"]}, weights={"foo": 1.5, "bar": 0.25})
    rows = judge_urls(frame, vocabulary=light, url="link").orderBy("link").collect()
    assert [(r.verdict, r.strict_terms, r.soft_terms, r.soft_weight, r.host) for r in rows] == [
        ("allow", [], ["bar", "foo"], 1.75, "a.net"), ("block", ["Baz"], [], 0.0, "a.net"),
    ]
    assert Terms(Vocabulary(strict=[], soft={})).hits("casino") == ([], [])


def test_rules_are_checked():
    assert Rules([("allow", "b.org/"), ("block", "org/a")]).find("a.b.org", "/a") == ("b.org/", "allow")
    for wrong in ([("allow", "org")], [("deny", "org/")], [("allow", "org/"), ("block", "org/")]):
        with pytest.raises(ValueError):
            Rules(wrong)


def test_query_blocks_the_telling_hosts(spark, tables):
    rows = [r for r in QUERIES["op11_weighted_url_vocabulary"](spark, tables).collect() if r.rule is None]
    assert rows and all((r.verdict == "block") == ("-" in r.host) for r in rows)
