import random
from collections import Counter
from itertools import combinations

import pytest

from numberplace.llm import url_rules as U
from numberplace.llm.queries import URL_RULES

from .conftest import rows_of

URLS = [None, "", "foo", "http://", "HTTP://Ä.EXAMPLE.Net/en/x?y", "http://a.net", "http://net/?q", "http://xnet/",
        "x://b.org/fr/://z", "a\nb://h.org/fr/", "http://www.example.com/de/9.html#top", "http://example.com/fr/?a=1&b",
        "https://h#f/x", "https://h?x/y", "http://example.net/en/1", "http://example.net/eng"]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:stop]


def listed(host, path):
    fits = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_parts_and_listed_rules(spark, clashing):
    df = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[4])], "page_id long, url string")
    for table in (df, clashing(df.withColumnRenamed("url", "u0")).drop("url").withColumnRenamed("u0", "url")):
        for r in U.judge(table, URL_RULES).collect():
            url = URLS[4] if r.page_id is None else URLS[r.page_id]
            assert (r.host, r.path) == plain(url)
            rule, verdict = listed(*plain(url))
            assert r.rule == rule and (rule is None or r.verdict == verdict) and r.verdict in ("allow", "block")
    assert rows_of(U.judge(df.limit(0), URL_RULES)) == []


def test_tokens(spark):
    row = spark.createDataFrame([("http://m.A.net/en/9x/b.html?p=1&q=2&p=3#f",), ("x",), (None,)], "url string")
    found = [set(r[0]) for r in row.select(U.tokens("url")).collect()]
    assert found == [{"h:m", "h:a", "h:net", "p:en", "p:b.html", "q:p", "q:q", "f:"}, set(), set()]


def mined(baskets, support, confidence):
    """All rules by counting every token set."""
    n, sets, with_label = len(baskets), Counter(), Counter()
    for tokens, label in baskets:
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                sets[part] += 1
                with_label[part, label] += 1
    rules = {k: (c / sets[k[0]], c / n) for k, c in with_label.items() if c >= support * n and c / sets[k[0]] >= confidence}
    return {k: v for k, v in rules.items()
            if not any((k[0][:i] + k[0][i + 1 :], k[1]) in rules and rules[k[0][:i] + k[0][i + 1 :], k[1]][0] >= v[0]
                       for i in range(len(k[0])))}


def test_rules_and_verdicts_by_brute_force(spark):
    rng = random.Random(7)
    urls = [f"http://{rng.choice(['a', 'b', 'c'])}.{rng.choice(['x', 'y', 'net', 'org'])}/{rng.choice(['en', 'de', 'fr'])}/"
            f"{rng.randint(0, 99)}{rng.choice(['', '?q=1', '#t'])}" for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = [(k, "block" if ".x/" in u and "/de/" in u or rng.random() < 0.03 else "allow") for k, u in enumerate(urls) if k % 2]
    labelled = spark.createDataFrame(labels, "page_id long, label string")
    tokens = {r.page_id: frozenset(r.t) for r in df.select("page_id", U.tokens("url").alias("t")).collect()}
    known = dict(labels)
    baskets = []
    for k, u in enumerate(urls):
        verdict = listed(*plain(u))[1] or known.get(k)
        if verdict:
            baskets.append((tokens[k], verdict))
    rules = mined(baskets, 0.02, 0.9)
    assert any(label == "block" for _, label in rules)
    for r in U.judge(df, URL_RULES, labelled, min_support=0.02, min_confidence=0.9).collect():
        if r.rule is None:
            fits = [(-c, -s, -len(a), label != "block", list(a), label) for (a, label), (c, s) in rules.items()
                    if set(a) <= tokens[r.page_id]]
            best = min(fits, default=None)
            assert r.verdict == (best[5] if best else U.DEFAULT)
            assert r.mined == (best[4] if best else None)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    plan = U.judge(df, URL_RULES)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan


@pytest.mark.parametrize("size", [0, 1])
def test_few_labels(spark, size):
    baskets = spark.createDataFrame([(["t"], "block")][:size], "tokens array<string>, label string")
    assert [r.label for r in U.mine_rules(baskets).collect()] == ["block"] * size
