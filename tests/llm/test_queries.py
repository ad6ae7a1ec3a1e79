"""Registered queries: against SQL, and the pipeline against brute force."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import difference, oracle_connection
from panelspan.llm.frames import table
from panelspan.llm.jaccard import Rule
from panelspan.llm.queries import ORACLE, QUERIES
from tests.helpers import plan
from tests.llm.messy import empty, messy
from tests.llm.test_jaccard import brute as components_of
from tests.llm.test_mixing import draw, identity, unit
from tests.llm.test_winnowing import brute as contamination_of

SF = "/root/testdata/sf0.001"
NATIVE = ("op1_", "op6_", "op7_", "op8_", "op9_", "op10_", "op12_")


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert entry.queries().keys() >= {*QUERIES, "pipeline"}
    assert set(ORACLE) <= set(entry.oracle_sql()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    with oracle_connection(SF) as connection:
        assert difference(QUERIES[name](spark, SF), ORACLE[name], connection) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    if name.startswith(NATIVE):
        assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_the_rest_works_without_the_folder(tmp_path):
    root = Path(entry.__file__).parent
    for name in ("__spark_entry__.py", "checks", "panelspan"):
        (tmp_path / name).symlink_to(root / name) if name != "panelspan" else None
    (tmp_path / "panelspan").mkdir()
    for part in (root / "panelspan").iterdir():
        if part.name != "llm":
            (tmp_path / "panelspan" / part.name).symlink_to(part)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/bin"})


def listed(frame):
    return sorted((r["doc_id"], r["text"], r["source"]) for r in frame.collect())


def test_pipeline_stages_match_brute_force(spark):
    """Each stage on the rows that the one before kept, over the smallest tables."""
    source = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, source, SF)
    kept = listed(good)
    assert set(kept) <= set(listed(source)) and len(kept) > 0.8 * source.count()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert sum(labels.get(d) == 0 for d, _, _ in kept) <= 1

    alone = listed(stages["near_copies"](spark, good, SF))
    roots = components_of([t for _, t, _ in kept], Rule())
    assert alone == [row for i, row in enumerate(kept) if roots[i][1] == i]

    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    frame = spark.createDataFrame(alone, "doc_id long, text string, source string")
    clean = listed(stages["benchmark"](spark, frame, SF))
    assert clean == [row for row in alone if not contamination_of(row[1], items)[1]]

    frame = spark.createDataFrame(clean, "doc_id long, text string, source string")
    mixed = listed(stages["mix"](spark, frame, SF))
    size = {}
    for _, _, s in clean:
        size[s] = size.get(s, 0) + 1
    total = sum(n**0.5 for n in size.values())
    expected = []
    for row in clean:
        rate = size[row[2]] ** 0.5 / total * len(clean) / size[row[2]]
        own = unit(corpus_pipeline.MIX_SEED, identity(*row), 1, "draw", 1)
        expected += [row] * draw(rate, own)
    assert mixed == sorted(expected)

    frame = spark.createDataFrame(mixed, "doc_id long, text string, source string")
    shards = stages["shards"](spark, frame, SF)
    assert listed(shards) == mixed
    places = [(r["shard"], r["slot"]) for r in shards.collect()]
    assert len(set(places)) == len(mixed) and {p[0] for p in places} <= set(range(24))


def test_the_pipeline_runs_on_its_tables(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns[-3:] == ["size", "shard", "slot"]
    assert 0 < found.count() <= 2 * table(spark, SF, "documents").count()


def test_stages_stand_messy_rows_and_empty_tables(spark):
    for rows in (messy(spark), empty(spark)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == rows.columns
            docs = spark.createDataFrame(after.collect(), after.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.count() == docs.count()
