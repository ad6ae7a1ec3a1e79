"""A journal of the swap of staged outputs, so that a program that died can be made up for.

The journal is written into the hidden folders of the publication before the first rename.
All outputs are whole by then, so a swap that was begun is finished; only where the program
had already begun to restore the old outputs is that finished instead. Every step
looks at what lies where, so it may be repeated after another failure.

One of the folders holds the journal itself, the others a link to it: a link without its
journal belongs to a swap that never began or is already over.
"""

from __future__ import annotations

import json
import logging
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from panelspan.sinks.files import Files

log = logging.getLogger(__name__)

JOURNAL, LINK, RESTORING = "_swap.json", "_swap.link", "_restoring"


@dataclass
class Swap:
    """A target, its staged output, and where its old output goes, if it has one."""

    target: str
    staged: str
    old: str | None = None


@dataclass
class Journal:
    """All swaps of a publication, and its hidden folders; the first holds the journal."""

    swaps: list[Swap]
    folders: list[str]

    @property
    def path(self) -> str:
        return f"{self.folders[0]}/{JOURNAL}"

    @property
    def restoring(self) -> str:
        return f"{self.folders[0]}/{RESTORING}"

    def write(self, files: Files) -> None:
        """Links first: the journal itself is what makes the swap begin."""
        content = json.dumps(
            {"swaps": [asdict(swap) for swap in self.swaps], "folders": self.folders}
        )
        for folder in self.folders[1:]:
            files.write(f"{folder}/{LINK}", content)
        files.write(self.path, content)

    @staticmethod
    def read(files: Files, folder: str) -> Journal | None:
        for name in (JOURNAL, LINK):
            if files.exists(f"{folder}/{name}"):
                found = json.loads(files.read(f"{folder}/{name}"))
                return Journal([Swap(**swap) for swap in found["swaps"]], found["folders"])
        return None

    def close(self, files: Files) -> None:
        """Delete the folders, the one with the journal last."""
        for folder in reversed(self.folders):
            files.delete(folder)


def recover(spark: SparkSession, target: str) -> bool:
    """Finish the publications of ``target`` that a dead program left half swapped.

    After it the target, and all other outputs of the same publication, are either the new
    ones or the old ones. Returns whether there was anything to do. Raises ``OSError`` where a
    file system that does not rename in one step left an output in part at two places; both
    stay as they are. No other program may be publishing to the target meanwhile.
    """
    files = Files(spark)
    wanted = files.qualified(target)
    found = False
    for folder in files.hidden_folders(target):
        journal = Journal.read(files, folder)
        if journal is None or wanted not in [files.qualified(s.target) for s in journal.swaps]:
            continue
        found = True
        if not files.exists(journal.path):
            files.delete(folder)
        else:
            _finish(files, journal)
            journal.close(files)
    return found


def _finish(files: Files, journal: Journal) -> None:
    restoring = files.exists(journal.restoring)
    log.warning("%s the swap of %s", "Restoring before" if restoring else "Finishing",
                [swap.target for swap in journal.swaps])
    for swap in reversed(journal.swaps) if restoring else journal.swaps:
        (_back if restoring else _forward)(files, swap)


def _there(files: Files, swap: Swap) -> tuple[bool, bool, bool]:
    """Whether target, staged and old output exist."""
    places = tuple(bool(p) and files.exists(p) for p in (swap.target, swap.staged, swap.old))
    if all(places):
        raise OSError(
            f"{swap.target} was moved in part: the old output is in {swap.old}, the new one "
            f"in {swap.staged}"
        )
    return places


def _forward(files: Files, swap: Swap) -> None:
    target, staged, _ = _there(files, swap)
    if not staged:
        if not target:
            raise OSError(f"Neither {swap.target} nor {swap.staged} exists")
        return
    if target:
        if swap.old is None:
            raise OSError(f"{swap.target} has appeared while {swap.staged} was to go there")
        files.rename(swap.target, swap.old)
    files.rename(swap.staged, swap.target)


def _back(files: Files, swap: Swap) -> None:
    target, staged, old = _there(files, swap)
    if swap.old is None or old:
        # What is at the target is the new output, whole or in part.
        if target:
            files.delete(swap.target)
        if old:
            files.rename(swap.old, swap.target)
