"""Counts of what a load loses without a word: values that were none of their
type, and rows without a match in a required lookup.

An :class:`Audit` in the :class:`~dimforge.config.Settings` of a build has its
staging and joins observed (Spark's observation metrics): the counts come with
the job that writes the table, from the rows it reads anyway.

    audit = Audit()
    load_site(raw, registry, owner, settings=replace(settings, audit=audit))
    audit.counts()
    # {"ID_UPNIVEL1": {"not_typed": 3}, "join on ID_FILIAL": {"rows": 90, "lost": 2}}
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from inspect import signature

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: (name, raw column, typed column) of the casts made while a build is audited.
_casts: ContextVar[list[tuple[str, Column, Column]] | None] = ContextVar("casts", default=None)
_audit: ContextVar["Audit | None"] = ContextVar("audit", default=None)


def _name(c) -> str:
    return c if isinstance(c, str) else str(c)[8:-2]


def note_cast(c, raw: Column, made: Column) -> Column:
    """Called where a raw column is typed; :func:`observed` takes the casts of its projection."""
    casts = _casts.get()
    if casts is not None:
        casts.append((_name(c), raw, made))
    return made


@contextmanager
def auditing(audit: "Audit | None") -> Iterator[None]:
    """The staging functions called inside are observed by ``audit``, if there is one."""
    tokens = _audit.set(audit), _casts.set([] if audit else None)
    try:
        yield
    finally:
        _audit.reset(tokens[0])
        _casts.reset(tokens[1])


def audited(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A build whose staging and joins are observed by the audit of its settings."""
    where = list(signature(build).parameters).index("settings")

    @wraps(build)
    def run(*args, **kwargs):
        settings = kwargs.get("settings", args[where] if len(args) > where else None)
        with auditing(settings.audit if settings else None):
            return build(*args, **kwargs)

    return run


def observed(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """``df.select(columns)``; in an audited build the casts among them are counted."""
    audit, casts = _audit.get(), _casts.get()
    if not casts:
        return df.select(*columns)
    noted = list(casts)
    casts.clear()
    return audit.typed(df, list(columns), noted)


def watched(df: DataFrame, c, raw: Column, made: Column) -> DataFrame:
    """``df``, with the values counted that are NULL once typed, in an audited build."""
    audit = _audit.get()
    return df if audit is None else audit.typed(df, [F.col(f"`{n}`") for n in df.columns], [(_name(c), raw, made)])


class Audit:
    """Counts of one load; filled by the jobs that run its plans."""

    def __init__(self):
        self._seen: list[tuple[str, dict[str, str], Observation]] = []
        self._lock = threading.Lock()

    def _observe(self, df: DataFrame, metrics: dict[str, tuple[str, str, Column]]) -> DataFrame:
        """``metrics``: by column name, what they are told under, as what, and the count."""
        seen = Observation()
        with self._lock:
            for at, (name, what, _) in metrics.items():
                self._seen.append((name, {at: what}, seen))
        return df.observe(seen, *[c.alias(at) for at, (_, _, c) in metrics.items()])

    def typed(self, df: DataFrame, columns: list[Column], casts: list[tuple[str, Column, Column]]) -> DataFrame:
        """The projection, with counts of raw values whose typed value is NULL."""
        flags = {f"__r{i}": (raw.isNotNull() & made.isNull()).cast("int") for i, (_, raw, made) in enumerate(casts)}
        names = df.select(*columns).columns
        wide = df.select(*columns, *[c.alias(at) for at, c in flags.items()])
        metrics = {at: (casts[i][0], "not_typed", F.sum(at)) for i, at in enumerate(flags)}
        return self._observe(wide, metrics).select(*[F.col(f"`{n}`") for n in names])

    def joined(self, left: DataFrame, side: DataFrame, on, name: str) -> DataFrame:
        """An inner join, with counts of its rows and of left rows without a match."""
        hit = "__hit"
        joined = left.join(side.withColumn(hit, F.lit(True)), on, "left")
        metrics = {"__rows": (name, "rows", F.count(F.lit(1))), "__lost": (name, "lost", F.sum(F.when(F.col(hit), 0).otherwise(1)))}
        return self._observe(joined, metrics).where(F.col(hit)).drop(hit)

    def counts(self, wait: float = 10.0) -> dict[str, dict[str, int]]:
        """Per raw column and join the counts so far.  A part of a plan that no
        job has run (or that Spark saw to be empty) is left out after ``wait`` seconds."""
        out: dict[str, dict[str, int]] = {}
        got: dict[int, dict] = {}
        with self._lock:
            seen = list(self._seen)
        waiters = []
        for obs in {id(o): o for _, _, o in seen}.values():
            thread = threading.Thread(target=lambda o=obs: got.__setitem__(id(o), o.get), daemon=True)
            thread.start()
            waiters.append(thread)
        for thread in waiters:
            thread.join(wait if not got else wait / len(waiters))
        for name, metrics, obs in seen:
            for at, what in metrics.items():
                if id(obs) in got:
                    held = out.setdefault(name, {})
                    held[what] = held.get(what, 0) + int(got[id(obs)][at] or 0)
        return out
