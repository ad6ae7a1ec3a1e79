import random
import re

import duckdb

from checks.compare import difference
from panelspan.llm.queries import op8_winnowing
from panelspan.llm.winnowing import WINNOWING_ORACLE, contamination, decontaminate
from tests.llm.messy import COPY, as_rows, docs, empty, messy

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, shared=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        if not b or item is None:
            continue
        size = min(shared, len(b))
        windows = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(w), hit, sorted(found)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def check(spark, texts, items, shared=10):
    found = contamination(docs(spark, texts), bench(spark, items), shared=shared).collect()
    assert len(found) == len(texts)
    for row in found:
        n, hit, names = brute(texts[row["key"]], items, shared)
        covered = {p for s in row["spans"] for p in range(s["start"], s["end"])}
        assert (row["n_words"], covered, row["items"]) == (n, hit, names)
        ends = [(s["start"], s["end"]) for s in row["spans"]]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_every_shared_span_is_found(spark):
    random_ = random.Random(4)

    def text(n, vocabulary):
        return " ".join(random_.choice(vocabulary) for _ in range(n))

    few, many = ["a", "B", "c"], [f"w{i}" for i in range(300)]
    items = [(i, text(random_.randrange(1, 40), many)) for i in range(20)]
    items += [(50 + i, text(random_.randrange(1, 14), few)) for i in range(8)]
    texts = [text(random_.randrange(0, 60), few) for _ in range(30)]
    for _ in range(40):
        body = items[random_.randrange(20)][1].split()
        start = random_.randrange(len(body))
        cut = body[start : start + random_.randrange(1, 25)]
        texts.append(f"{text(20, many)}, {'; '.join(cut).upper()} - {text(9, many)}")
    check(spark, texts, items)
    check(spark, texts, items, shared=3)


def test_short_items_are_one_window(spark):
    items = [(1, "Übung macht"), (2, "x"), (3, ""), (4, None), (None, "never listed words")]
    check(spark, ["die übung macht x", "die Übung macht y", "", "never listed words"], items)


def test_messy_rows_and_empty_tables(spark):
    items = [(7, COPY)]
    found = contamination(messy(spark), bench(spark, items))
    assert found.count() == 12  # one repeated row
    hit = {r["key"] for r in found.collect() if r["items"] == ["7"]}
    assert hit == {5, 6, 9}
    none = contamination(messy(spark), bench(spark, []))
    assert {len(r["spans"]) for r in none.collect()} == {0}
    assert contamination(empty(spark), bench(spark, items)).collect() == []


def test_clean_rows_stay_as_they_are(spark):
    source = messy(spark)
    kept = decontaminate(source, bench(spark, [(7, COPY)]))
    assert kept.columns == source.columns
    expected = source.filter(f"text IS NULL OR text <> '{COPY}'")
    assert as_rows(kept, *source.columns) == as_rows(expected, *source.columns)


def test_items_without_an_id_count_in_the_query_and_the_pipeline(spark, tmp_path):
    texts = ["a never listed text b", "x known text", "never listed text, known text", "clean"]
    items = [(None, "never listed text"), (None, "known text"), (3, "known text"), (None, None)]
    tables = {"documents": docs(spark, texts), "benchmark": bench(spark, items)}
    connection = duckdb.connect()
    for name, frame in tables.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')"
        )
    assert difference(op8_winnowing(spark, str(tmp_path)), WINNOWING_ORACLE, connection) is None
    kept = decontaminate(tables["documents"], tables["benchmark"]).collect()
    assert [r["text"] for r in kept] == ["clean"]


def test_a_long_shared_text_and_a_phrase_of_very_many_items(spark):
    """Work grows with the words: every window of a long text is shared, and one phrase is in
    3,000 items. Times are not compared, the result is."""
    long = " ".join(f"w{i}" for i in range(20_000))
    common = "these ten words stand in very many of the items"
    items = [(i, f"{common} u{i} v{i}") for i in range(3000)] + [(9000, long)]
    texts = ["x y " + long + " z", f"before {common} after {common}", "nothing here", common]
    found = {
        r["key"]: r
        for r in contamination(
            docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")
        ).collect()
    }
    assert [tuple(x) for x in found[0]["spans"]] == [(2, 20_002)] and found[0]["items"] == ["9000"]
    assert [tuple(x) for x in found[1]["spans"]] == [(1, 11), (12, 22)]
    assert found[1]["items"] == found[3]["items"] == sorted(str(i) for i in range(3000))
    assert found[2]["spans"] == [] and [tuple(x) for x in found[3]["spans"]] == [(0, 10)]


def test_repeated_windows_inside_a_text(spark):
    """Runs of one fingerprint: the same words over and over."""
    items = [(1, "a a a a a a a a a a"), (2, "b a b a b a b a b a"), (3, "c")]
    texts = ["a " * 40, "a b " * 30, "b " * 5 + "a " * 12 + "b a " * 9 + "c", "a " * 9]
    found = contamination(
        docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    )
    for r in found.collect():
        words, hit, ids = brute(texts[r["key"]], items)
        assert sum(x["end"] - x["start"] for x in r["spans"]) == len(hit)
        assert r["items"] == ids
