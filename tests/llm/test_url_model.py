"""URL rules and the character model, against plain counting."""

import math
import random
from collections import Counter
from hashlib import md5

import pytest

from panelspan.llm import url_model
from panelspan.llm.url_model import ALLOW, BLOCK, HostRule, filter_urls, score_urls, threshold
from tests.llm.messy import empty, messy
from pyspark.sql import functions as F


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for mark in "?#":
        rest = rest.split(mark, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def ruled(url, rules=url_model.RULES):
    host, path = parts(url)
    fits = [
        r for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def grams(url, context):
    padded = "\x02" * context + url + "\x03"
    return [padded[i : i + context + 1] for i in range(len(url) + 1)]


class Brute:
    """A Witten-Bell model of characters, from counts in dictionaries."""

    def __init__(self, urls, context):
        self.counts = Counter()
        for url in urls:
            for gram in grams(url, context):
                for order in range(context + 1):
                    self.counts[gram[context - order :]] += 1
        self.all, self.next = Counter(), Counter()
        for gram, n in self.counts.items():
            self.all[gram[:-1], len(gram)] += n
            self.next[gram[:-1], len(gram)] += 1

    def p(self, gram):
        lower = self.p(gram[1:]) if len(gram) > 1 else url_model.UNSEEN
        n, t = self.all[gram[:-1], len(gram)], self.next[gram[:-1], len(gram)]
        if n < url_model.LEAST_SEEN:
            return lower
        return (self.counts[gram] + t * lower) / (n + t)


def brute_scores(labels, context, folds):
    fold = {u: int(md5(u.encode()).hexdigest()[:8], 16) % folds for u in labels}
    models = {}
    for out in range(folds + 1):
        for of in (0, 1):
            own = [u for u, x in labels.items() if x == of and fold[u] != out]
            models[of, out] = Brute(own, context)
    found = {}
    for url, label in labels.items():
        out = folds if label is None else fold[url]
        differences = [
            math.log(models[1, out].p(g)) - math.log(models[0, out].p(g))
            for g in grams(url, context)
        ]
        found[url] = sum(differences) / len(differences)
    return found


def made_urls(n, seed=2):
    random_ = random.Random(seed)
    return [
        f"http{random_.choice(['', 's'])}://{random_.choice(['www.', 'm.', ''])}"
        f"{random_.choice(['alpha', 'beta', 'spam'])}.example.{random_.choice(['org', 'com', 'net'])}"
        f"/{random_.choice(['en', 'de', 'fr', 'es'])}/{random_.randrange(300)}"
        for _ in range(n)
    ]


ODD = [
    None, "", "no scheme", "http://", "http://ORG/x", "HTTP://Sub.Example.ORG/es/1?x=/de/",
    "a://b://c.org/x", "http://org", "http://notorg/x", "http://x.org?a/b", "http://x.org#/es/",
    "http://example.org/en/1", "http://example.org/en/2", "http://x.com/fr/", "http://x.com/FR/",
    "http://com/de/5", "http://x.org:80/a", "http://é😀.org/ü", "http://x.net/" + "a" * 5000,
    "http://bücher.org/es/", "x\n://y.org/z\nw", "://org/",
]


def test_hosts_paths_and_rules(spark):
    rows = list(enumerate(ODD))
    frame = spark.createDataFrame(rows, "page_id long, url string")
    for r in filter_urls(frame).collect():
        assert (r["host"], r["path"]) == parts(r["url"]), r["url"]
        rule = ruled(r["url"])
        assert r["rule"] == (rule.name if rule else None)
        assert rule is None or r["verdict"] == rule.verdict


@pytest.mark.parametrize("context, folds", [(0, 2), (2, 3), (4, 4)])
def test_scores_match_brute_force(spark, context, folds):
    random_ = random.Random(7)
    labels = {u: random_.choice([0, 1, None]) for u in made_urls(80)} | {"é😀x": 1, "q": None}
    frame = spark.createDataFrame(list(labels.items()), "url string, label int")
    found = {r["url"]: r["score"] for r in score_urls(frame, context, folds).collect()}
    expected = brute_scores(labels, context, folds)
    assert found.keys() == expected.keys()
    for url in expected:
        assert abs(found[url] - expected[url]) < 1e-8


def test_the_threshold_makes_the_least_errors(spark):
    random_ = random.Random(9)
    for _ in range(4):
        rows = [("u", x, random_.gauss(x, 0.7)) for x in random_.choices([0, 1], k=60)]
        rows += [("u", None, 5.0), ("u", 0, -3.0), ("u", 1, 3.0)]
        found = threshold(spark.createDataFrame(rows, "url string, label int, score double"))

        def errors(cut):
            missed = sum(x == 0 and s >= cut for _, x, s in rows) / sum(x == 0 for _, x, _ in rows)
            lost = sum(x == 1 and s < cut for _, x, s in rows) / sum(x == 1 for _, x, _ in rows)
            return missed + lost

        least = min(errors(step / 256) for step in range(-1500, 1500))
        assert abs(errors(found) - least) < 1e-9


def test_the_model_tells_what_no_rule_names(spark):
    random_ = random.Random(3)
    word = {1: ["garden", "library", "museum"], 0: ["casino", "pills", "jackpot"]}
    urls, truth = [], {}
    for i in range(600):
        good, zone = random_.randrange(2), random_.choice(["ok", "bad", "new"])
        if zone != "new":
            zone = "ok" if good else "bad"
        url = f"http://{random_.choice(word[good])}{random_.randrange(99)}.{zone}.test/{i}"
        urls.append((i, url))
        truth[url] = good
    rules = [HostRule(ALLOW, "ok.test", "/"), HostRule(BLOCK, "bad.test", "/")]
    found = filter_urls(spark.createDataFrame(urls, "page_id long, url string"), rules).collect()
    judged = [r for r in found if r["rule"] is None]
    right = sum((r["verdict"] == ALLOW) == bool(truth[r["url"]]) for r in judged)
    assert len(judged) > 100 and right / len(judged) > 0.95


def test_one_verdict_for_every_copy_of_a_url(spark, monkeypatch):
    urls = made_urls(60) + ["http://hot.net/x"] * 500 + [None] * 300
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    broadcast = filter_urls(frame)
    monkeypatch.setattr(url_model, "fits_broadcast", lambda df: False)
    names = ("page_id", "url", "rule", "score", "verdict")
    shuffled = sorted(map(repr, filter_urls(frame).select(*names).collect()))
    assert shuffled == sorted(map(repr, broadcast.select(*names).collect()))
    assert len(shuffled) == len(urls)
    hot = filter_urls(frame).filter("url = 'http://hot.net/x'").select("score", "verdict")
    assert hot.distinct().count() == 1


def test_without_accepted_or_rejected_urls_all_are_allowed(spark):
    frame = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.net/x")], "page_id int, url string")
    found = {r["page_id"]: (r["score"], r["verdict"]) for r in filter_urls(frame).collect()}
    assert found == {1: (None, ALLOW), 2: (None, ALLOW)}


def test_messy_rows_and_empty_tables(spark):
    source = messy(spark).withColumn("Host", F.lit("x")).withColumn("rule", F.lit(3))
    found = filter_urls(source, url="text", key="doc_id")
    assert found.columns[-5:] == ["host", "path", "rule", "score", "verdict"]
    assert "Host" not in found.columns
    assert found.count() == source.count()
    assert {r["verdict"] for r in found.collect()} == {ALLOW}
    assert filter_urls(empty(spark), url="text", key="doc_id").count() == 0
