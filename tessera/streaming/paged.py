"""Paged feeds as a stream: newest first, with a cursor, an early stop and a window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


class PagedSource(DataSource):
    """A stream of the pages that ``fetch(token) -> (rows, next token or None)`` gives, one sweep a batch.

    A sweep stops at a page cap, without a next token, after ``known_run``
    consecutive rows that ``known(row)`` has seen, or past the window's start;
    the page it stops in is kept whole.  Register a subclass that sets ``fetch``.
    """

    fetch: Callable
    known: Callable = staticmethod(lambda row: False)
    fields = "id string, text string, created_at string"
    known_run, max_pages, since = 3, 5, ""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.fields

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Sweep(self)


class _Sweep(SimpleDataSourceStreamReader):
    def __init__(self, source: PagedSource):
        self.source = source

    def initialOffset(self) -> dict:
        return {"sweep": 0}

    def read(self, start: dict):
        rows, _ = sweep(self.source.fetch, self.source.known, self.source.known_run, self.source.max_pages, self.source.since)
        if start["sweep"] or not rows:
            return iter([]), start
        return iter(rows), {"sweep": start["sweep"] + 1}

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter(sweep(self.source.fetch, self.source.known, self.source.known_run, self.source.max_pages, self.source.since)[0])


def sweep(fetch: Callable, known: Callable, known_run: int, max_pages: int, since: str = "") -> tuple[list[tuple], str]:
    """The rows of one sweep, and why it ended: known, window, exhausted or cap."""
    rows, token, run = [], None, 0
    for _ in range(max_pages):
        page, token = fetch(token)
        ended = ""
        for row in page:
            run = run + 1 if known(row) else 0
            if run >= known_run:
                ended = ended or "known"
            if since and row[-1] < since:
                ended = ended or "window"
        rows += [tuple(r) for r in page]
        if ended or token is None:
            return rows, ended or "exhausted"
    return rows, "cap"


def full_walk_due(last: Column, today: Column, every: int = 7) -> Column:
    """Whether a source was never walked in full, or ``every`` days ago or more."""
    return last.isNull() | (F.date_diff(today, last) >= every)


def cache_status(fetched: Column, now: Column, forced: Column, disabled: Column, minutes: int = 90) -> Column:
    """How a read-through cache answers: no-cache, forced, miss, hit or incremental."""
    age = (F.unix_timestamp(now) - F.unix_timestamp(fetched)) / 60
    return (
        F.when(disabled, "no-cache").when(forced, "forced").when(fetched.isNull(), "miss").when(age <= minutes, "hit").otherwise("incremental")
    )


def query_set_key(queries: Column) -> Column:
    """Twelve digits that name a set of queries whatever their order."""
    return F.substring(F.sha1(F.array_join(F.array_sort(F.transform(queries, lambda q: F.trim(q))), "\0")), 1, 12)


def read_amplified(reads: Column, created: Column, cap: Column, reason: Column, share: float = 0.6) -> Column:
    """Whether a run read ``share`` of its cap or more without a reason or anything to show for it."""
    return (reads >= cap * share) & reason.isNull() & (created < reads * (1 - share))
