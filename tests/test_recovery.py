"""Publications whose program dies: the next one, or ``recover``, makes up for it."""

import os

import pytest

import panelspan as ps
from panelspan.sinks.files import Files
from tests.helpers import rows

CHANGES = ("rename", "delete", "write", "make_folder")
LOOKS = ("exists", "read", "qualified", "hidden_folders", "total_bytes", "part_files")


class Killed(BaseException):
    """The program is dead: nothing it does any more has an effect."""


def die_after(monkeypatch, steps, fail_rename=None):
    """Let ``steps`` changes of the file system pass, and nothing at all after them.

    ``fail_rename``: the number of a rename that fails by itself, so that the old outputs
    are being restored when the program dies.
    """
    state = {"left": steps, "renames": 0, "dead": False}

    def wrapped(name, changes):
        real = getattr(Files, name)

        def call(self, *args):
            if state["dead"] or (changes and state["left"] == 0):
                state["dead"] = True
                raise Killed
            if changes:
                state["left"] -= 1
            if name == "rename":
                state["renames"] += 1
                if state["renames"] == fail_rename:
                    raise OSError("no rename")
            return real(self, *args)

        monkeypatch.setattr(Files, name, call)

    for name in CHANGES:
        wrapped(name, True)
    for name in LOOKS:
        wrapped(name, False)
    return state


def value(spark, path):
    return [r[0] for r in rows(spark.read.parquet(path))] if os.path.exists(path) else None


def publish_three(spark, folder, first):
    """Two folders with outputs: a and b have old ones, c is new, and lies elsewhere."""
    with ps.Publication(spark) as publication:
        for place, name in enumerate(("x/a", "y/b", "y/c")):
            publication.stage_parquet(spark.range(first + place, first + place + 1), f"{folder}/{name}")


def prepare(spark, folder):
    ps.publish(spark.range(1, 2), f"{folder}/x/a")
    ps.publish(spark.range(2, 3), f"{folder}/y/b")


def outcome(spark, folder):
    return [value(spark, f"{folder}/{name}") for name in ("x/a", "y/b", "y/c")]


OLD, NEW = [[1], [2], None], [[11], [12], [13]]


def hidden(folder):
    return [n for part in ("x", "y") for n in os.listdir(f"{folder}/{part}") if n.startswith(".")]


# Staging makes 3 folders; the swap makes 2 more, writes a journal with 4 links, renames 5
# times and deletes 5 folders.
FIRST, LAST = 3, 3 + 2 + 5 + 5 + 5


@pytest.mark.parametrize("steps", range(FIRST, LAST + 1))
def test_a_kill_between_any_two_steps_of_the_swap(spark, tmp_path, monkeypatch, steps):
    prepare(spark, tmp_path)
    with monkeypatch.context() as dying:
        state = die_after(dying, steps)
        if steps < LAST:
            with pytest.raises(Killed):
                publish_three(spark, tmp_path, 11)
        else:
            publish_three(spark, tmp_path, 11)
            assert not state["dead"]
    # Each target alone leads to all of them.
    target = f"{tmp_path}/" + ("x/a", "y/b", "y/c")[steps % 3]
    found = ps.recover(spark, target)
    began = steps >= FIRST + 2 + 5
    assert outcome(spark, tmp_path) == (NEW if began else OLD)
    assert not ps.recover(spark, target)
    if began:
        for name in ("x/a", "y/b", "y/c"):
            ps.recover(spark, f"{tmp_path}/{name}")
        assert hidden(tmp_path) == []
    # Links may go before the journal, and a journal before the last folder is gone.
    assert found or not began or steps > LAST - 5


# Restoring takes two steps for each rename that was begun, and one for its mark.
@pytest.mark.parametrize(
    "fail_rename, later", [(f, n) for f in range(1, 6) for n in range(1, 2 * f + 2)]
)
def test_a_kill_while_the_old_outputs_are_restored(
    spark, tmp_path, monkeypatch, fail_rename, later
):
    prepare(spark, tmp_path)
    with monkeypatch.context() as dying:
        die_after(dying, FIRST + 2 + 5 + fail_rename + later - 1, fail_rename)
        with pytest.raises((Killed, OSError)):
            publish_three(spark, tmp_path, 11)
    for name in ("x/a", "y/b", "y/c"):
        ps.recover(spark, f"{tmp_path}/{name}")
    # Without the mark that restoring has begun, the swap is finished instead.
    assert outcome(spark, tmp_path) == (NEW if later == 1 else OLD)
    assert hidden(tmp_path) == []


def test_recovery_may_die_as_well(spark, tmp_path, monkeypatch):
    for steps in range(10):
        folder = tmp_path / str(steps)
        prepare(spark, folder)
        with monkeypatch.context() as dying:
            die_after(dying, FIRST + 2 + 5 + 1)
            with pytest.raises(Killed):
                publish_three(spark, folder, 11)
        assert value(spark, f"{folder}/x/a") is None
        with monkeypatch.context() as dying:
            die_after(dying, steps)
            try:
                ps.recover(spark, f"{folder}/y/b")
            except Killed:
                pass
        for name in ("x/a", "y/b", "y/c"):
            ps.recover(spark, f"{folder}/{name}")
        assert outcome(spark, folder) == NEW and hidden(folder) == []


def test_the_next_publication_of_one_target_finishes_all(spark, tmp_path, monkeypatch):
    prepare(spark, tmp_path)
    with monkeypatch.context() as dying:
        die_after(dying, FIRST + 2 + 5 + 3)
        with pytest.raises(Killed):
            publish_three(spark, tmp_path, 11)
    ps.publish(spark.range(50, 51), f"{tmp_path}/y/c")
    assert outcome(spark, tmp_path) == [[11], [12], [50]]
    assert hidden(tmp_path) == []


def test_nothing_is_done_to_other_folders(spark, tmp_path):
    prepare(spark, tmp_path)
    other = tmp_path / "x" / ".staging-of-a-program-that-runs"
    other.mkdir()
    assert not ps.recover(spark, f"{tmp_path}/x/a")
    assert not ps.recover(spark, f"{tmp_path}/nowhere/a")
    assert other.exists() and outcome(spark, tmp_path) == OLD


def test_an_output_in_part_at_two_places_is_left_alone(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/a"
    ps.publish(spark.range(1), target)
    with monkeypatch.context() as dying:
        # 1 folder staged, 1 for the old output, journal and link, then the first rename.
        die_after(dying, 1 + 1 + 2 + 1)
        with pytest.raises(Killed):
            ps.publish(spark.range(2), target)
    os.mkdir(target)
    before = sorted(os.walk(tmp_path))
    with pytest.raises(OSError, match="moved in part"):
        ps.recover(spark, target)
    assert sorted(os.walk(tmp_path)) == before
    ps.publish(spark.range(5), target)
    assert spark.read.parquet(target).count() == 5
