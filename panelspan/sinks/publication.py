"""Write outputs to a staging folder, then swap them all into place.

Nothing at a target changes until every output has been written. The swap is
two renames per target: the old output aside, the new one in. If one fails, all
targets get their old output back, wherever the failure left it; a backup is only
deleted once its target is whole again. A target may be the very file an output was
computed from. On object stores a rename is a copy and not atomic.

A journal of the swap is written before the first rename. If the program dies, the next
publication of one of the targets, or ``recover``, finishes what was begun.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspan.functions import column
from panelspan.sinks.files import Files, shared_folder
from panelspan.sinks.journal import Journal, Swap, recover
from panelspan.sources.dimension import CSV_QUOTING

log = logging.getLogger(__name__)

CSV_OPTIONS = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    **CSV_QUOTING,
}


class Publication:
    """Several outputs that appear together or not at all; use it in a ``with`` block."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._files = Files(spark)
        self._folders: list[str] = []
        self._staged: list[tuple[str, str]] = []
        self._targets: list[str] = []
        self._journal: Journal | None = None

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, error_type, error, traceback) -> None:
        try:
            if error_type is None:
                self._swap()
        finally:
            # The folder with the journal goes last.
            first = self._journal.folders[0] if self._journal else None
            for folder in sorted(self._folders, key=lambda f: f == first):
                self._files.delete(folder)

    def _claim(self, target: str) -> None:
        """Raise if the target is, holds or lies in that of another output.

        Here also a publication that died over this target is finished.
        """
        full = self._files.qualified(target)
        for other in self._targets:
            if f"{full}/".startswith(f"{other}/") or f"{other}/".startswith(f"{full}/"):
                raise ValueError(f"Two outputs at one place: {other} and {full}")
        try:
            recover(self._spark, target)
        except Exception:
            # What is left of it stays; the target is about to be replaced anyway.
            log.exception("An earlier publication of %s could not be finished", target)
        self._targets.append(full)

    def _folder(self, target: str) -> str:
        folder = self._files.staging_folder(target)
        self._files.make_folder(folder)
        self._folders.append(folder)
        return folder

    def table(self, df: DataFrame, near: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write an intermediate table that goes with the block, and read it.

        It is computed once, whatever executors are lost later and whatever
        happens to the files that ``df`` came from. It lies in the folder that the
        session names in ``spark.checkpoint.dir``, or else next to ``near``.
        """
        folder = shared_folder(self._spark)
        if folder is None:
            folder = self._folder(near)
        else:
            self._folders.append(folder)
        path = f"{folder}/table"
        df.write.partitionBy(*partition_by).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def stage_parquet(
        self,
        df: DataFrame,
        target: str,
        compression: str | None = None,
        partition_by: Sequence[str] = (),
    ) -> str:
        """Write a Parquet dataset for ``target``; return where it can be read until the swap."""
        self._claim(target)
        staged = f"{self._folder(target)}/{self._files.name(target)}"
        writer = df.write
        if compression:
            writer = writer.option("compression", compression)
        writer.partitionBy(*partition_by).parquet(staged)
        self._staged.append((staged, target))
        return staged

    def stage_parts(self, parts: Sequence[DataFrame], target: str, by: str) -> str:
        """Write tables with columns of their own as one dataset, partitioned by a column.

        Each is found under its value of ``by``; with ``mergeSchema`` all are read as one.
        """
        self._claim(target)
        staged = f"{self._folder(target)}/{self._files.name(target)}"
        self._files.make_folder(staged)
        for part in parts:
            part.write.mode("append").partitionBy(by).parquet(staged)
        self._staged.append((staged, target))
        return staged

    def stage_csv(
        self,
        df: DataFrame,
        target: str,
        single_file: bool = False,
        order_by: Sequence[str] = (),
    ) -> str:
        """Write CSV with a header for ``target``: a folder of files, or one file.

        ``order_by`` sorts the rows over all files. The caller alone decides which it
        is: a single file is sorted and written by many tasks, in parts that are joined in
        order under one header. Readers take either under the same path.
        """
        self._claim(target)
        folder = self._folder(target)
        staged = f"{folder}/{self._files.name(target)}"
        if order_by:
            # The place of a row in a written table breaks ties, so that many copies of
            # one row can be sorted by several tasks.
            df = self.table(df, target)
            place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
            placed = df.select("*", place[0].alias("_file"), place[1].alias("_row"))
            order = [column(name) for name in order_by]
            df = placed.orderBy(*order, "_file", "_row").drop("_file", "_row")
        if single_file:
            self._write_csv(df.limit(0).coalesce(1), f"{folder}/header")
            self._write_csv(df, f"{folder}/parts", header=False)
            parts = self._files.part_files(f"{folder}/header")
            if len(parts) != 1:
                raise RuntimeError(f"Expected one header for {target}, found {len(parts)}")
            # Spark numbers the files of a sorted table in its order.
            self._files.join_files(parts + self._files.part_files(f"{folder}/parts"), staged)
        else:
            self._write_csv(df, staged)
        self._staged.append((staged, target))
        return staged

    def stage_inside(self, df: DataFrame, path: str, format: str = "parquet") -> None:
        """Write a table into a folder of a staged dataset, to appear with it."""
        if format == "parquet":
            df.write.parquet(path)
        else:
            self._write_csv(df, path)

    @staticmethod
    def _write_csv(df: DataFrame, path: str, header: bool = True) -> None:
        df.write.options(**{**CSV_OPTIONS, "header": header}).csv(path)

    def _swap(self) -> None:
        swaps = []
        for staged, target in self._staged:
            old = None
            if self._files.exists(target):
                old = f"{self._folder(target)}/{self._files.name(target)}"
            swaps.append(Swap(self._files.qualified(target), staged, old))
        if not swaps:
            return
        places = [swap.old or swap.staged for swap in swaps]
        first = next(f for f in self._folders if places[0].startswith(f"{f}/"))
        others = [f for f in self._folders if f != first and self._holds(swaps, f)]
        self._journal = Journal(swaps, [first, *others])
        self._journal.write(self._files)
        aside: set[str] = set()
        begun: list[Swap] = []
        try:
            for swap in swaps:
                begun.append(swap)
                if swap.old is not None:
                    self._files.rename(swap.target, swap.old)
                    aside.add(swap.target)
                self._files.rename(swap.staged, swap.target)
        except BaseException:
            self._files.write(self._journal.restoring, "")
            for swap in reversed(begun):
                self._restore(swap, swap.target in aside)
            raise

    @staticmethod
    def _holds(swaps: list[Swap], folder: str) -> bool:
        """Whether a swap moves something into or out of a folder."""
        places = [place for swap in swaps for place in (swap.staged, swap.old) if place]
        return any(place.startswith(f"{folder}/") for place in places)

    def _restore(self, swap: Swap, aside: bool) -> None:
        """Bring back what was at a target before, wherever a failed rename left it.

        ``aside`` says that the old output had been moved aside as a whole.
        """
        try:
            there = self._files.exists(swap.target)
            if swap.old is None:
                if there:
                    self._files.delete(swap.target)
            elif self._files.exists(swap.old):
                if there and not aside:
                    # Which of the two is whole cannot be told: both stay.
                    raise OSError("the old output was moved in part")
                if there:
                    self._files.delete(swap.target)
                self._files.rename(swap.old, swap.target)
        except Exception:
            log.exception("%s could not be restored from %s", swap.target, swap.old)
            # The old output stays where it is, with the journal that tells of it.
            kept = (str(swap.old), self._journal.path)
            self._folders = [
                f for f in self._folders if not any(place.startswith(f"{f}/") for place in kept)
            ]


def publish(
    df: DataFrame,
    target: str,
    format: str = "parquet",
    single_file: bool = False,
    order_by: Sequence[str] = (),
) -> None:
    """Replace one output by ``df`` once all of it has been written."""
    with Publication(df.sparkSession) as publication:
        if format == "parquet":
            publication.stage_parquet(df, target)
        elif format == "csv":
            publication.stage_csv(df, target, single_file, order_by)
        else:
            raise ValueError(f"Unknown format {format!r}: use parquet or csv")
