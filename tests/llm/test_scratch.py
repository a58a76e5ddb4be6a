"""Folders of scratch work: which go at the end, which stay, and threads that don't touch each other's."""

import os
import threading

from vitals.llm import common


def folder(df) -> str:
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://").removeprefix("file:"))


def test_scratch_keeps_what_is_outside(spark):
    with common.scratch(spark):
        a = folder(common.written(spark.range(3), "inner"))
        b = folder(common.outside(spark.range(3), "kept"))
        with common.scratch(spark):
            c = folder(common.outside(spark.range(3), "one-level-up"))
        assert all(map(os.path.isdir, (a, b, c)))
    assert [os.path.isdir(x) for x in (a, b, c)] == [False, True, False]


def test_threads_have_their_own_scratch(spark):
    """A thread's scratch ends while this one's is open: this one's folder stays, the other's goes."""
    other = []

    def work():
        with common.scratch(spark):
            other.append(folder(common.written(spark.range(3), "thread")))

    with common.scratch(spark):
        mine = folder(common.written(spark.range(3), "mine"))
        thread = threading.Thread(target=work)
        thread.start()
        thread.join()
        assert os.path.isdir(mine) and not os.path.isdir(other[0])
    assert not os.path.isdir(mine)
