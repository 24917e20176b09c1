"""A line for each stage of a run: what ran, on what, how long, and what came out of it.

Counts are observed while the stage's own job runs, so nothing is read a second time for them.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation

log = logging.getLogger("statuta.progress")


class Step:
    """What a stage says of itself: observed counts and free words."""

    def __init__(self) -> None:
        self.seen: list[Observation] = []
        self.words: list[str] = []

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """``df`` with named aggregates that are known once an action has run on it."""
        seen = Observation()
        self.seen.append(seen)
        return df.observe(seen, *[c.alias(n) for n, c in counts.items()])

    def detail(self) -> str:
        return " · ".join([f"{n} {v:,}" if isinstance(v, int) else f"{n} {v}" for s in self.seen for n, v in s.get.items() if v is not None] + self.words)


@contextmanager
def step(name: str, service: str = "spark") -> Iterator[Step]:
    """Run a stage and log its line; a stage that fails says so and raises."""
    said, began = Step(), time.perf_counter()
    try:
        yield said
    except BaseException as e:
        log.info("  %-10s %-12s %s   %.2f s", name, service, type(e).__name__, time.perf_counter() - began)
        raise
    log.info("  %-10s %-12s %s   %.2f s", name, service, said.detail(), time.perf_counter() - began)


def setup(verbose: bool = True) -> None:
    """Lines to the terminal's error stream."""
    logging.basicConfig(format="%(message)s")
    log.setLevel(logging.INFO if verbose else logging.WARNING)
