import random

import pytest
from pyspark.sql import functions as F

from panelspan.llm.revisits import PERMITTED, canonical_url, resolve_revisits

SCHEMA = (
    "record_id long, url string, time long, status int, headers map<string,string>,"
    " payload string, block string, found int"
)


def records(spark, *rows):
    return spark.createDataFrame([(*r, "b", 1) for r in rows], SCHEMA).repartition(3)


def result(frame):
    return {r["record_id"]: r for r in frame.collect()}


@pytest.mark.parametrize("url, canonical", [
    ("HTTP://WWW.Example.org:80/a/b/?b=2&utm_source=x&a=1#top", "example.org/a/b?a=1&b=2"),
    ("https://example.org", "example.org"),
    ("https://example.org/", "example.org"),
    ("example.org/A/?gclid=5", "example.org/A"),
    (" https://m.example.org:8443/a?&& ", "m.example.org:8443/a"),
    ("", ""),
])
def test_canonical_urls(spark, url, canonical):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(canonical_url(F.col("url"))).first()[0] == canonical


def test_outcomes_and_headers(spark):
    full = {"ETag": '"1"', "Content-Type": "text/html", "Date": "d0", "Last-Modified": "m"}
    found = result(resolve_revisits(records(
        spark,
        (1, "http://a.org/x", 10, 200, full, "old"),
        (2, "https://www.a.org/x/", 20, 200, {**full, "etag": '"2"'} | {"ETag": '"2"'}, "new"),
        (3, "http://a.org/x?utm_id=1", 30, 304, {"etag": 'W/"2"', "DATE": "d1", "Content-Type": "no",
                                                 "Expires": "e"}, None),
        (4, "http://a.org/x", 20, 304, {"ETag": '"1"'}, None),
        (5, "http://a.org/x", 5, 304, {"ETag": '"1"'}, None),
        (6, "http://a.org/x", 40, 304, {"ETag": '"1"', "Last-Modified": "m"}, None),
        (7, "http://a.org/x", 40, 304, {"Last-Modified": "m"}, None),
        (8, "http://a.org/x", 40, 304, None, None),
        (9, None, 40, 304, {"ETag": '"1"'}, None),
        (10, "http://a.org/x", None, 304, {"ETag": '"1"'}, None),
        (11, "http://a.org/x", 35, 404, full, "gone"),
    )))
    assert {k: (r["outcome"], r["response_id"], r["payload"]) for k, r in found.items()} == {
        3: ("resolved", 2, "new"),
        4: ("resolved", 1, "old"),
        5: ("no_response", None, None),
        6: ("mismatch", 2, None),
        7: ("resolved", 2, "new"),
        8: ("no_validator", 2, None),
        9: ("no_response", None, None),
        10: ("no_response", None, None),
    }
    assert found[3]["headers"] == {
        "etag": 'W/"2"', "date": "d1", "expires": "e", "content-type": "text/html",
        "last-modified": "m",
    }
    assert found[6]["headers"] == {"etag": '"1"', "last-modified": "m"}


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_the_latest_earlier_response_with_and_without_blocks(spark, hot_rows):
    random_ = random.Random(hot_rows)
    rows = []
    for i in range(400):
        url = f"http://a.org/{random_.choice('aaaaaaabc')}"
        time = random_.randrange(60)
        status = random_.choice([200, 304])
        tag = {"ETag": str(random_.randrange(2))}
        rows.append((i, url, time, status, tag, f"p{i}" if status == 200 else None))
    found = result(resolve_revisits(records(spark, *rows), hot_rows=hot_rows))
    assert len(found) == sum(r[3] == 304 for r in rows)
    for record, url, time, status, tag, _ in rows:
        if status == 304:
            earlier = [r for r in rows if r[3] == 200 and r[1] == url and r[2] < time]
            best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
            row = found[record]
            assert row["response_id"] == (best[0] if best else None)
            if best:
                same = best[4] == tag
                assert row["outcome"] == ("resolved" if same else "mismatch")
                assert row["payload"] == (best[5] if same else None)


def test_repeated_rows_and_empty_tables(spark):
    one = (1, "u", 1, 200, {"ETag": "x"}, "p")
    again = (2, "u", 2, 304, {"ETag": "x"}, None)
    nameless = (None, "u", 3, 304, {"ETag": "x"}, None)
    found = resolve_revisits(records(spark, one, one, again, again, nameless)).collect()
    assert [r["payload"] for r in found] == ["p"] * 3
    assert resolve_revisits(records(spark, one).limit(0)).collect() == []
    assert "content-type" not in PERMITTED


@pytest.mark.parametrize("order", [1, -1])
def test_one_copy_of_a_repeated_response_counts(spark, order):
    """Id 1 has two responses: the earlier counts, and its payload is never the other's."""
    copies = [
        (1, "http://a.org/x", 10, 200, {"ETag": '"A"', "X": "a"}, "bodyA"),
        (1, "http://a.org/x", 12, 200, {"ETag": '"B"', "X": "b"}, "bodyB"),
        (1, "http://a.org/x", None, 200, {"ETag": '"C"'}, "bodyC"),
    ][::order]
    found = result(resolve_revisits(records(
        spark,
        *copies, *copies,
        (2, "http://a.org/x", 20, 304, {"ETag": '"A"'}, None),
        (3, "http://a.org/x", 20, 304, {"ETag": '"B"'}, None),
        (4, "http://a.org/x", 20, 304, {"ETag": '"C"'}, None),
    )))
    assert (found[2]["outcome"], found[2]["payload"]) == ("resolved", "bodyA")
    assert found[2]["headers"] == {"etag": '"A"', "x": "a"}
    for key in (3, 4):
        assert (found[key]["outcome"], found[key]["payload"]) == ("mismatch", None)


@pytest.mark.parametrize("url", ["http://a.org/x", "http://b.org/x"])
def test_copies_of_one_time_are_chosen_by_their_content(spark, url):
    """Equal times: the least digest of the payload counts, wherever the copies are."""
    from hashlib import md5

    bodies = ["one", "two", "three", "four"]
    least = min(bodies, key=lambda b: md5(b.encode()).hexdigest())
    rows = [(1, url, 10, 200, {"ETag": f'"{b}"'}, b) for b in bodies]
    rows += [(i + 2, url, 20, 304, {"ETag": f'"{b}"'}, None) for i, b in enumerate(bodies)]
    rows += [(9, "http://other.org", 20, 304, {}, None)]
    for parts in (1, 5):
        frame = spark.createDataFrame([(*r, "b", 1) for r in rows], SCHEMA).repartition(parts)
        found = result(resolve_revisits(frame))
        payloads = {r["payload"] for r in found.values()}
        assert payloads == {least, None}
        assert sum(r["outcome"] == "resolved" for r in found.values()) == 1


def test_one_response_that_most_revisits_stand_for(spark):
    rows = [(1, "http://a.org/x", 10, 200, {"ETag": '"1"'}, "hot"),
            (2, "http://b.org/x", 10, 200, {"ETag": '"1"'}, "unwanted"),
            (3, "http://c.org/x", 10, 200, {"ETag": '"1"'}, "cold")]
    rows += [(i, "http://a.org/x", i, 304, {"ETag": '"1"'}, None) for i in range(100, 2100)]
    rows += [(i, "http://c.org/x", i, 304, {"ETag": '"1"'}, None) for i in range(3000, 3010)]
    rows += [(i, f"http://none{i}.org/x", i, 304, {}, None) for i in range(4000, 6000)]
    found = result(resolve_revisits(records(spark, *rows)))
    assert len(found) == 4010
    assert sum(r["payload"] == "hot" for r in found.values()) == 2000
    assert sum(r["payload"] == "cold" for r in found.values()) == 10
    assert sum(r["outcome"] == "no_response" for r in found.values()) == 2000
