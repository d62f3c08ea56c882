"""URL parts, rules and the classifier against plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from peerledger.llm import queries
from peerledger.llm.queries import RULES, UNWANTED, WANTED, labelled_urls
from peerledger.llm.url_filter import ALLOW, BLOCK, FEATURES, GRAMS, SEEDS, STEP, Rule, judge, train

SCHEMA = "page_id bigint, url string, host string, path string, score int, features string"
URLS = [
    None,
    "",
    "no scheme at all",
    "://",
    "http://",
    "http://Example.ORG",
    "http://example.org/",
    "HTTP://WWW.Example.org/ES/1",
    "https://www.example.org/es/1?x=http://other.com/de/",
    "https://a.b.example.org/en/1#top",
    "https://a.b.example.org/en/2",
    "https://notexample.org/es/1",
    "https://org/x",
    "https://shop.com/fr/1",
    "https://shop.com/de",
    "https://shop.com/de/",
    "https://shop.com?de/",
    "https://shop.com#/de/",
    "https://user:pw@shop.com:80/de/1",
    "ftp://casino-jackpot.net/en/1",
    "https://ÄÖ.com/fr/ß\nline",
    "https://x.net/" + "abc/" * 20000,
    "a://b://c/d",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    found = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]


def fitting(host, path, rules):
    able = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(able, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)


def slot(seed, gram):
    code = (int(seed) + len(gram)) % 2**64
    for c in gram:
        code = (code ^ ord(c)) * int(STEP) % 2**64
        code ^= code >> 29
    return code % FEATURES


def probability(model, host, path):
    found = set()
    for name, part in (("host", host), ("path", path)):
        if part:
            framed = f"^{part}$"
            found |= {slot(SEEDS[name], framed[i : i + n]) for n in GRAMS for i in range(len(framed) - n + 1)}
    return 1 / (1 + math.exp(-model.intercept - sum(model.coefficients[k] for k in found)))


@pytest.fixture(scope="module")
def model(spark):
    return train(labelled_urls(spark))


def test_judged_urls(spark, model):
    rows = [(i, u, "h", "p", 1, "f") for i, u in enumerate(URLS)] + [(3, URLS[8], None, None, None, None), (None, URLS[8], "", "", 0, "")]
    rules = [*RULES, Rule(BLOCK, "b.example.org", "/"), Rule(ALLOW, "shop.com", "/de/1")]
    got = judge(spark.createDataFrame(rows, SCHEMA).repartition(3), model, rules).collect()
    expected = Counter()
    for key, url, *_ in rows:
        host, path = parts(url)
        rule = fitting(host, path, rules)
        expected[(key, host, path, rule and rule.host + rule.path, rule and rule.verdict)] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got) == expected
    for r in got:
        if len(r.path) < 1000:
            assert r.score == pytest.approx(probability(model, r.host, r.path), abs=1e-9)
        if r.rule is None:
            assert r.verdict == (BLOCK if r.score >= 0.5 else ALLOW)


def test_held_out_names(spark, model):
    """Names that are not in the table: unwanted words in other company, and made-up names."""
    draw = random.Random(4)
    names = [(f"{draw.choice(UNWANTED)}-{draw.choice(['star', 'best', 'zone', 'hub', '24'])}", 1) for _ in range(200)]
    names += [("".join(draw.choice(["mor", "lin", "tha", "ren", "dol", "wes", "ka", "bri", "sto"]) for _ in range(3)), 0) for _ in range(200)]
    names += [(f"{draw.choice(WANTED)}-{draw.choice(['star', 'best', 'zone', 'hub', '24'])}", 0) for _ in range(200)]
    urls = [(i, f"http://{draw.choice(['', 'www.', 'm.'])}{n}.example.{draw.choice(['com', 'net'])}/en/{draw.randrange(10**5)}", y) for i, (n, y) in enumerate(names)]
    got = {r.page_id: r.verdict for r in judge(spark.createDataFrame(urls, "page_id bigint, url string, y int"), model).collect()}
    blocked = [sum(got[i] == BLOCK for i, _, y in urls if y == label) for label in (0, 1)]
    assert blocked[0] <= 0.05 * 400 and blocked[1] >= 0.65 * 200


def test_tables_without_rows(spark, model):
    assert judge(spark.createDataFrame([], SCHEMA), model, RULES).count() == 0


def test_rows_without_a_label_are_left_out(spark):
    rows = [("http://good.com/", 0), ("http://bad.com/", 1)]
    more = spark.createDataFrame([*rows, ("http://odd.com/", None), (None, None)], "url string, blocked int")
    assert train(more).intercept == train(spark.createDataFrame(rows, "url string, blocked int")).intercept


def test_query(spark, tmp_path):
    rows = [(i, u, "<html>") for i, u in enumerate(URLS)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in queries.op12_url_filter(spark, str(tmp_path)).collect()}
    assert [got[i].rule for i in (6, 8, 9, 13, 15)] == ["org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/"]
    assert [got[i].verdict for i in (6, 8, 9, 13, 15, 19)] == [ALLOW, BLOCK, BLOCK, ALLOW, BLOCK, BLOCK]
    assert got[5].rule is None and got[0].host == got[0].path == ""
