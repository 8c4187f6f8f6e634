"""One run at a time: a run claims a store by a file of its own.

A run puts its file into the store's ``claims`` folder and then looks: if any other
live file is there it takes its own back, waits a little, and tries again some times.
Of two runs at least one sees the other's file, as each looks after it has written, so
two never hold the store together; it takes nothing of a file system but that a listing
shows what was written before.

While a run lasts, its file is touched ten times per ``stale_after``. A file that was not
touched for that long is a dead run's, and the next run removes it. A run that was only
paused then finds its file gone before it commits, and gives up. Clocks of machines should
agree far better than ``stale_after``; on a store that keeps no times of files, that must
be longer than the longest run.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Event, Thread

from pyspark.sql import SparkSession

from daybook.errors import ClaimError

TRIES = 5
WAIT_SECONDS = 0.5


class Claim:
    """A run's file, touched until it is given back."""

    def __init__(self, fs, path, stale_after: float) -> None:
        self._fs, self._path = fs, path
        self._stop = Event()
        self._beat = Thread(target=self._touch, args=(stale_after / 10,), daemon=True)
        self._beat.start()

    def _touch(self, every: float) -> None:
        while not self._stop.wait(every):
            try:
                self._fs.setTimes(self._path, int(time.time() * 1000), -1)
            except Exception:  # the file system may answer again by the next time; check() decides
                continue

    def check(self) -> None:
        """Raises if another run took this one for dead."""
        if not self._fs.exists(self._path):
            raise ClaimError(f"{self._path} was taken for a dead run's claim; nothing is committed")

    def give_back(self) -> None:
        self._stop.set()
        self._beat.join()
        self._fs.delete(self._path, False)


@contextmanager
def claimed(spark: SparkSession, folder: str, stale_after: float) -> Iterator[Claim]:
    """Hold the claim on what ``folder`` belongs to; raises if another run keeps it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    path = spark._jvm.org.apache.hadoop.fs.Path(root, uuid.uuid4().hex)
    holder = None
    for n in range(TRIES):
        if n:
            time.sleep(random.uniform(0, WAIT_SECONDS * n))
        holder = _other_holder(fs, root, path, stale_after)
        if holder is None:
            break
    else:
        raise ClaimError(f"another run is at work: {holder}")
    claim = Claim(fs, path, stale_after)
    try:
        yield claim
    finally:
        claim.give_back()


def _other_holder(fs, root, path, stale_after: float) -> str | None:
    """Put the file down; if another live one is there, take it back and say which."""
    fs.create(path, False).close()
    try:
        now = fs.getFileStatus(path).getModificationTime()
        others = [s for s in fs.listStatus(root) if s.getPath().getName() != path.getName()]
        dead = [s for s in others if now - s.getModificationTime() > 1000 * stale_after]
        live = [s for s in others if s not in dead]
        for s in dead:
            fs.delete(s.getPath(), False)
    except BaseException:
        fs.delete(path, False)
        raise
    if not live:
        return None
    fs.delete(path, False)
    return live[0].getPath().toString()
