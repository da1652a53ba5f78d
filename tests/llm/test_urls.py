import random
import re

import numpy as np
import pyarrow as pa

from adspindle.llm.queries import QUERIES
from adspindle.llm.text import raw_texts
from adspindle.llm.urls import BLOCKED_GLOBS, RULES, Automaton, judge_urls

from . import brute


def glob_fits(glob, text):
    parts = {"*": "(?s:.*)", "?": "(?s:.)"}
    return re.fullmatch("".join(parts.get(c, re.escape(c)) for c in glob), text) is not None


def judged(url):
    host, path = brute.url_parts(url)
    fit = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        rule, verdict = max(fit, key=lambda f: len(f[0]))
        return host, path, rule, verdict, None
    glob = next((g for g in BLOCKED_GLOBS if glob_fits(g, f".{host}{path}")), None)
    return host, path, None, "block" if glob else "allow", glob


def test_automaton_is_glob_matching():
    rng = random.Random(1)
    globs = ["*a*b", "a?c", "*", "", "**", "ab*", "x" * 70 + "*y", "*aab", "?", "??*", "*?b*", "a**b", "*y"]
    texts = ["".join(rng.choice("abcxy") for _ in range(rng.randint(0, 6))) for _ in range(1500)]
    texts += ["x" * 70 + "y", "x" * 70 + "aay", "x" * 71, "", "a" * 3000 + "b"]
    found = Automaton.of([g.encode() for g in globs]).fits(*raw_texts(pa.array(texts)))
    assert (found == np.array([[glob_fits(g, t) for g in globs] for t in texts])).all()


def test_urls(spark):
    hosts = ["net", "a.net", "example.net", "x.Example.NET", "notexample.net", "example.com", "org", "b.org", "cheap-pills.example.com"]
    paths = ["", "/", "/en", "/en/", "/en/1?x=/de/", "/de/2#top", "/fr/", "/x.net/", "?/fr/", "/wp-login.php", "//fr/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths]
    urls += [None, "", "no scheme", "://", ":// /", "http://", "ftp://ORG/fr/é\n/x", "http://net/" + "y" * 20000, "a://b://net/"]
    urls += ["http://example.org/net/", "http://spam-farm.example.org/fr/1", "http://net/"]
    pages = spark.createDataFrame([(i, u, "h", "other") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    found = {r["page_id"]: tuple(r)[1:] for r in judge_urls(pages).collect()}
    assert found == {i: judged(u) for i, u in enumerate(urls)}
    assert judge_urls(pages.limit(0)).count() == 0


def test_longest_rule_wins_whatever_the_order(spark):
    rules = (("allow", "a.b", "/"), ("block", "b", "/x/"), ("block", "b", "/"))
    pages = spark.createDataFrame([(1, "http://a.b/x/"), (2, "http://c.b/x/"), (3, "http://c.b/")], "page_id long, url string")
    for given in (rules, rules[::-1]):
        found = [(r["rule"], r["verdict"]) for r in judge_urls(pages, rules=given, globs=()).collect()]
        assert found == [("a.b/", "allow"), ("b/x/", "block"), ("b/", "block")]


def test_query_equals_its_oracle(spark):
    sf = "/root/testdata/sf0.01"
    brute.same_as_oracle(QUERIES["op3_url_filters"](spark, sf), "op3_url_filters", sf)
