"""Running several feeds side by side."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

# Fixed value: the feeds' polling cadence.
CADENCE = "120 seconds"
#: Seconds a failed feed waits before it starts again.
DELAY = 10.0

_LOG = logging.getLogger(__name__)


def _log(name: str, error: Exception) -> None:
    _LOG.error("feed %s failed: %s", name, error)


def run_feeds(
    feeds: Mapping[str, Callable[[], StreamingQuery]],
    lasting: bool = False,
    report: Callable[[str, Exception], None] = _log,
    delay: float = DELAY,
) -> None:
    """Run one query per feed until all have ended; every failure is reported at once.

    Lasting feeds go on for ever: one that fails starts again from its checkpoint after a
    delay, as often as it fails, while the others run on. Otherwise the feeds work on what
    is there now, and when all have ended the first failure is raised.
    """
    running = {name: begin() for name, begin in feeds.items()}
    waiting: dict[str, float] = {}
    first = None
    while running or waiting:
        for name in [n for n, at in waiting.items() if at <= time.monotonic()]:
            del waiting[name]
            running[name] = feeds[name]()
        for name, query in list(running.items()):
            try:
                if query.awaitTermination(1):
                    del running[name]
            except StreamingQueryException as error:
                del running[name]
                report(name, error)
                first = first or error
                if lasting:
                    waiting[name] = time.monotonic() + delay
        if not running:
            time.sleep(min(0.2, delay))
    if first and not lasting:
        raise first
