"""Staged publishing, CSV and exports."""

import csv
import os

import pytest
from pyspark.sql import functions as F

import panelspan as ps
from panelspan.sinks.files import Files
from tests.helpers import full_dimension, rows


def leftovers(folder):
    return [name for name in os.listdir(folder) if name.startswith(".")]


def test_publish_replaces_the_old_output(spark, tmp_path):
    target = f"{tmp_path}/out"
    ps.publish(spark.range(3), target)
    ps.publish(spark.range(5, 9), target)
    assert [r[0] for r in rows(spark.read.parquet(target))] == [5, 6, 7, 8]
    assert os.listdir(tmp_path) == ["out"]


def test_publish_creates_missing_folders(spark, tmp_path):
    ps.publish(spark.range(2), f"{tmp_path}/a/b/out")
    assert spark.read.parquet(f"{tmp_path}/a/b/out").count() == 2


def test_publish_replaces_a_file_and_an_unrelated_folder(spark, tmp_path):
    (tmp_path / "file").write_text("old")
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "part-old.parquet").write_text("old")
    for name in ("file", "folder"):
        ps.publish(spark.range(2), f"{tmp_path}/{name}")
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == 2


def test_failed_write_keeps_the_old_output(spark, tmp_path):
    target = f"{tmp_path}/out"
    ps.publish(spark.range(3), target)
    with pytest.raises(Exception, match="boom"):
        ps.publish(spark.range(3).select(F.raise_error(F.lit("boom")).alias("x")), target)
    assert spark.read.parquet(target).count() == 3
    assert os.listdir(tmp_path) == ["out"]


def test_output_may_replace_its_own_input(spark, tmp_path):
    target = f"{tmp_path}/out"
    ps.publish(spark.range(10), target)
    ps.publish(spark.read.parquet(target).filter("id > 6"), target)
    assert spark.read.parquet(target).count() == 3


def test_failure_between_outputs_publishes_none(spark, tmp_path):
    ps.publish(spark.range(1), f"{tmp_path}/a")
    with pytest.raises(RuntimeError, match="stop"):
        with ps.Publication(spark) as publication:
            publication.stage_parquet(spark.range(2), f"{tmp_path}/a")
            publication.stage_parquet(spark.range(2), f"{tmp_path}/b")
            raise RuntimeError("stop")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 1
    assert os.listdir(tmp_path) == ["a"]


@pytest.mark.parametrize("moved_first", [False, True])
@pytest.mark.parametrize("fail_at", [1, 2, 3, 4, 5])
def test_failed_swap_restores_every_old_output(
    spark, tmp_path, monkeypatch, fail_at, moved_first
):
    """Two targets exist, one is new: five renames, each failing in turn, before or after
    it has moved the data."""
    for name in ("a", "b"):
        ps.publish(spark.range(1), f"{tmp_path}/{name}")
    real, calls = Files.rename, []

    def rename(self, source, target):
        calls.append(source)
        if len(calls) == fail_at:
            if moved_first:
                real(self, source, target)
            raise OSError("no rename")
        real(self, source, target)

    monkeypatch.setattr(Files, "rename", rename)
    with pytest.raises(OSError, match="no rename"):
        with ps.Publication(spark) as publication:
            for name in ("a", "b", "c"):
                publication.stage_parquet(spark.range(7), f"{tmp_path}/{name}")
    assert sorted(os.listdir(tmp_path)) == ["a", "b"]
    for name in ("a", "b"):
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == 1


def test_an_output_moved_in_part_stays_in_both_places(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/a"
    ps.publish(spark.range(3), target)
    real = Files.rename

    def rename(self, source, to):
        real(self, source, to)
        Files.make_folder(self, target)
        raise OSError("copied in part")

    monkeypatch.setattr(Files, "rename", rename)
    with pytest.raises(OSError, match="in part"):
        ps.publish(spark.range(7), target)
    (kept,) = leftovers(tmp_path)
    assert os.path.isdir(target)
    assert spark.read.parquet(f"{tmp_path}/{kept}/a").count() == 3


@pytest.mark.parametrize("one, two", [("a", "a"), ("a", "a/"), ("a", "a/b"), ("a/b", "a")])
def test_two_outputs_at_one_place_raise(spark, tmp_path, one, two):
    with pytest.raises(ValueError, match="one place"):
        with ps.Publication(spark) as publication:
            publication.stage_parquet(spark.range(1), f"{tmp_path}/{one}")
            publication.stage_csv(spark.range(1), f"{tmp_path}/{two}")
    assert not os.path.exists(f"{tmp_path}/{one}")


def test_old_output_is_kept_when_it_cannot_be_restored(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/a"
    ps.publish(spark.range(1), target)
    real, calls = Files.rename, []

    def rename(self, source, target):
        calls.append(source)
        if len(calls) > 1:
            raise OSError("no rename")
        real(self, source, target)

    monkeypatch.setattr(Files, "rename", rename)
    with pytest.raises(OSError):
        ps.publish(spark.range(7), target)
    (kept,) = leftovers(tmp_path)
    assert spark.read.parquet(f"{tmp_path}/{kept}/a").count() == 1


def test_rename_never_moves_into_an_existing_folder(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    with pytest.raises(OSError):
        Files(spark).rename(f"{tmp_path}/a", f"{tmp_path}/b")


TRICKY = [
    ("b", ' say "hi", twice '), ("a", "line\nbreak"), ("c", None), ("a", "\\ back \\slash"),
]


def tricky(spark):
    return full_dimension(spark, *TRICKY).repartition(3)


@pytest.mark.parametrize("single", [True, False])
def test_csv_round_trip_in_order(spark, tmp_path, single):
    path = f"{tmp_path}/d.csv"
    ps.publish(tricky(spark), path, "csv", single_file=single, order_by=["id"])
    assert os.path.isfile(path) == single
    assert rows(ps.load_dimension(spark, path)) == rows(tricky(spark))
    parts = [path] if single else sorted(
        f"{path}/{name}" for name in os.listdir(path) if name.startswith("part-")
    )
    ids = []
    for part in parts:
        with open(part, newline="") as file:
            ids += [line["id"] for line in csv.DictReader(file)]
    assert ids == ["a", "a", "b", "c"]
    assert not leftovers(tmp_path) or all(n.endswith(".crc") for n in leftovers(tmp_path))


@pytest.mark.parametrize("n", [0, 1, 200_000])
def test_the_caller_alone_decides_between_file_and_folder(spark, tmp_path, n):
    ids = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("topic"))
    ps.publish(ids, f"{tmp_path}/file.csv", "csv", single_file=True)
    ps.publish(ids, f"{tmp_path}/folder.csv", "csv")
    assert os.path.isfile(f"{tmp_path}/file.csv") and os.path.isdir(f"{tmp_path}/folder.csv")
    assert ps.load_dimension(spark, f"{tmp_path}/file.csv").count() == n


def test_copies_of_one_row_are_sorted_by_several_tasks(spark, tmp_path):
    path = f"{tmp_path}/d.csv"
    copies = spark.range(20_000).select(F.lit("same").alias("id"), F.lit("t").alias("topic"))
    ps_conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(ps_conf, "false")
    try:
        ps.publish(copies, path, "csv", order_by=["id", "topic"])
    finally:
        spark.conf.unset(ps_conf)
    sizes = [
        os.path.getsize(f"{path}/{name}") for name in os.listdir(path) if name.startswith("part-")
    ]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3
    assert ps.load_dimension(spark, path).count() == 20_000


def test_single_csv_of_no_rows_has_a_header(spark, tmp_path):
    path = f"{tmp_path}/d.csv"
    ps.publish(tricky(spark).limit(0), path, "csv", single_file=True)
    assert open(path).read().strip() == ",".join(ps.DIMENSION.published)


def test_publish_knows_two_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="orc"):
        ps.publish(spark.range(1), f"{tmp_path}/x", "orc")
    with pytest.raises(ValueError, match="orc"):
        ps.publish(spark.range(1), f"{tmp_path}/p")
        ps.export_dataset(spark, f"{tmp_path}/p", f"{tmp_path}/x", "orc")


def parts(folder):
    return [name for name in os.listdir(folder) if name.startswith("part-")]


def test_export_makes_few_files_by_size(spark, tmp_path):
    source = f"{tmp_path}/source"
    spark.range(1000).select("id", F.hash("id").alias("h")).repartition(12).write.parquet(source)
    assert ps.export_dataset(spark, source, f"{tmp_path}/one") == 1
    (only,) = parts(f"{tmp_path}/one")
    assert ".zstd." in only
    assert rows(spark.read.parquet(f"{tmp_path}/one")) == rows(spark.read.parquet(source))

    size = Files(spark).total_bytes(source)
    several = ps.export_dataset(
        spark, source, f"{tmp_path}/several", source_bytes_per_file=size // 3
    )
    assert 3 <= several <= 4 and 1 < len(parts(f"{tmp_path}/several")) <= several

    for files in (1, 3, 20):
        for format in ("parquet", "csv"):
            target = f"{tmp_path}/{format}{files}"
            assert ps.export_dataset(spark, source, target, format, files=files) == files
            assert len(parts(target)) == files
    assert rows(spark.read.parquet(f"{tmp_path}/parquet20")) == rows(spark.read.parquet(source))
    with pytest.raises(ValueError, match="files"):
        ps.export_dataset(spark, source, f"{tmp_path}/none", files=0)

    ps.export_dataset(spark, source, f"{tmp_path}/csv", "csv")
    again = spark.read.csv(f"{tmp_path}/csv", header=True, schema="id bigint, h int")
    assert rows(again) == rows(spark.read.parquet(source))


def test_intermediate_tables_lie_in_the_shared_folder_and_go(spark, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr("panelspan.sinks.publication.shared_folder", lambda _: f"{shared}/mine")
    with ps.Publication(spark) as publication:
        table = publication.table(spark.range(4), near=f"{tmp_path}/out")
        assert table.count() == 4
        assert f"{shared}/mine" in table.inputFiles()[0]
    assert os.listdir(shared) == []
    ps.publish(tricky(spark), f"{tmp_path}/d.csv", "csv", single_file=True)
    assert os.listdir(shared) == []
    assert rows(ps.load_dimension(spark, f"{tmp_path}/d.csv")) == rows(tricky(spark))


def test_one_sorted_file_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Parts of a sorted table, joined in order: one header, and every copy of a row."""
    joined = []
    real = Files.join_files

    def join_files(self, parts, target):
        joined.append([os.path.getsize(p.removeprefix("file:")) for p in parts])
        real(self, parts, target)

    monkeypatch.setattr(Files, "join_files", join_files)
    source = spark.range(20_000).selectExpr(
        "concat('k', lpad(pmod(id * 7919, 5000), 5, '0')) AS id", "concat('a\"\n,', id % 3) AS v"
    )
    target = f"{tmp_path}/one.csv"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ps.publish(source, target, "csv", single_file=True, order_by=["id", "v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    ((header, *parts),) = joined
    assert len(parts) > 4 and max(parts) < 0.5 * sum(parts)
    with open(target, newline="") as file:
        listed = list(csv.reader(file))
    assert listed[0] == ["id", "v"]
    assert listed[1:] == sorted([r["id"], r["v"]] for r in source.collect())
    # Beside it only the checksum that Hadoop keeps for a local file.
    assert set(os.listdir(tmp_path)) <= {"one.csv", ".one.csv.crc"}


def test_one_file_without_rows_has_its_header(spark, tmp_path):
    for order in ([], ["a"]):
        source = spark.createDataFrame([], "a string, `b,c` string")
        ps.publish(source, f"{tmp_path}/x.csv", "csv", single_file=True, order_by=order)
        assert open(f"{tmp_path}/x.csv").read().splitlines() == ['a,"b,c"']


def test_exported_files_are_of_about_one_size(spark, tmp_path):
    """Whatever the parts of the source were: here one holds nine tenths of the rows."""
    source = f"{tmp_path}/parts"
    rows_ = spark.range(90_000).selectExpr("id", "sha2(cast(id AS string), 256) AS v")
    rows_.coalesce(1).write.parquet(source)
    for n in range(5):
        spark.range(2000).selectExpr("id", "'x' AS v").coalesce(1).write.mode("append").parquet(source)
    share = Files(spark).total_bytes(source) // 5
    n = ps.export_dataset(spark, source, f"{tmp_path}/out", source_bytes_per_file=share)
    sizes = [os.path.getsize(p.removeprefix("file:")) for p in Files(spark).part_files(f"{tmp_path}/out")]
    assert len(sizes) == n and 5 <= n <= 6
    assert max(sizes) < 1.2 * min(sizes)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 100_000


def test_export_bounds_the_rows_of_a_file_at_their_full_length(spark, tmp_path, monkeypatch):
    """Repeated text takes little room in the source and its full length on the way to a task."""
    monkeypatch.setattr("panelspan.sinks.export.ROW_BYTES_PER_FILE", 200_000)
    source = f"{tmp_path}/source"
    names = spark.range(4000).selectExpr("repeat('name', 50) AS name", "id", "id % 2 = 0 AS even")
    names.write.parquet(source)
    assert Files(spark).total_bytes(source) < 100_000
    for format in ("parquet", "csv"):
        # 4,000 rows of 200 bytes of text and 8 for each column.
        assert ps.export_dataset(spark, source, f"{tmp_path}/{format}", format) == 5
        assert len(parts(f"{tmp_path}/{format}")) == 5
    assert rows(spark.read.parquet(f"{tmp_path}/parquet")) == rows(spark.read.parquet(source))
    assert ps.export_dataset(spark, source, f"{tmp_path}/one", files=1) == 1
