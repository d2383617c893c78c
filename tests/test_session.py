from __future__ import annotations

from threading import Barrier
from time import sleep
from types import SimpleNamespace

import pytest

from agoralake.session import MB, scratch_folder, sizing, together

SCAN = "spark.sql.files.maxPartitionBytes"
SHUFFLE = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.mark.parametrize(
    "size, scan, shuffle",
    [(1, "128MB", "200"), (1024 * 1024 * MB, "128MB", "2048"), (100 * 1024**4, "262MB", "100000")],
)
def test_sizing(size, scan, shuffle):
    assert sizing(size) == {SCAN: scan, SHUFFLE: shuffle}


class Session:
    """Just what scratch_folder asks a session for."""

    def __init__(self, master: str, shared: str | None):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = SimpleNamespace(master=master)


@pytest.mark.parametrize("master", ["yarn", "local[4]"])
def test_scratch_folders_are_below_the_shared_one(master):
    session = Session(master, "s3a://shared/checkpoints/")
    first, second = scratch_folder(session), scratch_folder(session)
    assert first != second
    assert all(f.startswith("s3a://shared/checkpoints/agoralake-") for f in (first, second))


def test_steps_run_together_and_all_end_before_a_failure_is_raised(spark):
    done = []
    both = Barrier(2)

    def good() -> None:
        both.wait(20)
        sleep(0.3)
        done.append(spark.range(3).count())

    def bad() -> None:
        both.wait(20)
        raise ValueError("no")

    with pytest.raises(ValueError):
        together(spark, bad, good)
    assert done == [3]


def test_a_cluster_has_to_name_its_shared_folder():
    with pytest.raises(ValueError):
        scratch_folder(Session("yarn", None))
    assert scratch_folder(Session("local[4]", None))
