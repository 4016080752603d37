"""Things that a Python worker keeps between tasks, and gives up when it has not needed them for some seconds.

A worker serves one operator after another; what one of them keeps must not take the memory of the next.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Hashable
from contextlib import contextmanager

IDLE_SECONDS = 4


class Kept:
    """One value, made by ``make`` for a key and kept while it is used again and again."""

    def __init__(self, make: Callable):
        self.make, self.lock, self.timer = make, threading.Lock(), None
        self.key = self.value = None

    def _drop(self) -> None:
        with self.lock:
            self.key = self.value = None

    @contextmanager
    def use(self, key: Hashable):
        with self.lock:
            if self.timer is not None:
                self.timer.cancel()
            if self.key != key or self.value is None:
                self.key = self.value = None  # before the next one is made
                self.key, self.value = key, self.make(key)
            try:
                yield self.value
            finally:
                self.timer = threading.Timer(IDLE_SECONDS, self._drop)
                self.timer.daemon = True
                self.timer.start()
