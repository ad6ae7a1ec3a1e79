"""CSV files whose records span lines, read in splits: the same rows as by one task."""

import csv
import io
import random

import pytest

import panelspan as ps
from panelspan.sources.records import split_records
from tests.helpers import rows

NAMES = ps.DIMENSION.published
SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def small_splits(spark):
    """Splits of 64 bytes, so that most records begin and end in different ones."""
    spark.conf.set(SPLITS[0], "64")
    spark.conf.set(SPLITS[1], "0")
    yield
    for name in SPLITS:
        spark.conf.unset(name)


def written(listed, path, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(listed)
    path.write_bytes(out.getvalue().encode())


def both(spark, path, **options):
    whole = ps.load_dimension(spark, str(path), split_bytes=1 << 40, **options)
    split = ps.load_dimension(spark, str(path), split_bytes=0, **options)
    assert split.schema == whole.schema
    return rows(split), rows(whole)


PIECES = ["a", "b,c", '"', "\n", "\n\n", '""', " ", "é😀", "x" * 80, ",", "'", "line one\nline two", "\t"]


def made(random_, n):
    def field():
        return "".join(random_.choice(PIECES) for _ in range(random_.randrange(5)))

    return [[f"k{i}", *[field() for _ in NAMES[1:]]] for i in range(n)]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_files_give_the_rows_of_one_reader(spark, tmp_path, small_splits, seed, end):
    random_ = random.Random(seed)
    quoting = csv.QUOTE_ALL if seed % 2 else csv.QUOTE_MINIMAL
    for part in range(2):
        written([NAMES, *made(random_, 25)], tmp_path / f"{part}.csv", end, quoting)
    split, whole = both(spark, tmp_path)
    assert split == whole and len(split) == 50
    assert both(spark, tmp_path, columns=NAMES)[0] == whole


def test_a_field_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line "{i}", of one field' for i in range(60))
    listed = [NAMES, ["a", long, "", "", "", "T"], ["b", "x", "", "", "", long], ["c", "", "", "", "", "U"]]
    written(listed, tmp_path / "one.csv")
    split, whole = both(spark, tmp_path / "one.csv")
    assert split == whole and {r[0] for r in split} == {"a", "b", "c"}
    assert {r[1] for r in split} >= {long}


@pytest.mark.parametrize("shift", range(0, 64, 7))
def test_quotes_at_every_place_of_a_split(spark, tmp_path, small_splits, shift):
    listed = [list(NAMES)] + [[f"{'p' * shift}{i}", '"\n"', "", "", "", "\n"] for i in range(3)]
    written(listed, tmp_path / "one.csv")
    found = split_records(spark, f"{tmp_path}/one.csv").collect()
    records = [r["record"] for r in sorted(found, key=lambda r: (r["split"], r["place"]))]
    assert [next(csv.reader(io.StringIO(r))) for r in records] == listed


def test_many_tasks_read_one_file(spark, tmp_path, small_splits):
    written([NAMES, *made(random.Random(5), 100)], tmp_path / "one.csv")
    text = spark.read.option("lineSep", "\n").text(f"{tmp_path}/one.csv")
    assert text.rdd.getNumPartitions() > 50
    found = split_records(spark, f"{tmp_path}/one.csv").collect()
    assert len({r["split"] for r in found}) > 20


def test_empty_lines_and_files_without_rows(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("\n\n" + ",".join(NAMES) + "\n\na,,,,,T\n\n\n")
    (tmp_path / "b.csv").write_text(",".join(NAMES))
    split, whole = both(spark, tmp_path / "a.csv")
    assert split == whole == [("a", None, None, None, None, "T")]
    assert both(spark, tmp_path / "b.csv", columns=NAMES) == ([], [])


def test_headers_must_agree(spark, tmp_path, small_splits):
    written([NAMES, *made(random.Random(6), 3)], tmp_path / "a.csv")
    written([[*NAMES[:-1], "other"], *made(random.Random(6), 3)], tmp_path / "b.csv")
    with pytest.raises(ps.MissingColumns, match="differ"):
        ps.load_dimension(spark, str(tmp_path), split_bytes=0)
    with pytest.raises(ps.MissingColumns, match="differ"):
        ps.load_dimension(spark, f"{tmp_path}/b.csv", columns=NAMES, split_bytes=0)


def test_published_files_come_back_in_splits(spark, tmp_path, small_splits):
    listed = [tuple(r) for r in made(random.Random(7), 150)]
    source = spark.createDataFrame(listed, ", ".join(f"{n} string" for n in NAMES)).repartition(5)
    for one in (True, False):
        ps.publish(source, f"{tmp_path}/{one}.csv", "csv", single_file=one, order_by=["id"])
        split, whole = both(spark, f"{tmp_path}/{one}.csv")
        assert split == whole


def test_patterns_name_several_files(spark, tmp_path, small_splits):
    for part in "ab":
        written([NAMES, *made(random.Random(part), 10)], tmp_path / f"{part}.csv")
    (tmp_path / "other.txt").write_text("not to be read")
    split, whole = both(spark, tmp_path / "*.csv")
    assert split == whole and len(split) == 20
