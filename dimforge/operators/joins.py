"""Lookup joins with a size-checked broadcast.

A lookup side is broadcast only after its size is proven to be at most
``Settings.broadcast_max_rows`` rows and ``Settings.broadcast_max_bytes``
bytes of values; a side that grows with the data falls back to a shuffle
join (sort-merge), where AQE splits a skewed key over several tasks.  Sizes
recorded when a table was written prove it without a job; the other lookups
of a whole build are counted in one Spark job.
"""

from __future__ import annotations

import threading
import weakref
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.config import DEFAULT, Settings

# Results of earlier checks, per DataFrame object (a frame is immutable).
_checked: "weakref.WeakKeyDictionary[DataFrame, tuple[tuple[int, int], bool, int]]" = weakref.WeakKeyDictionary()
# A frame whose rows include all of the key frame's.
_supersets: "weakref.WeakKeyDictionary[DataFrame, DataFrame]" = weakref.WeakKeyDictionary()
# Sizes recorded when the rows a frame reads were written, and bounds derived from them:
# (rows, bytes of the text values) that a frame holds at most.
_sizes: "weakref.WeakKeyDictionary[DataFrame, Sizes]" = weakref.WeakKeyDictionary()
_bounds: "weakref.WeakKeyDictionary[DataFrame, tuple[int, int]]" = weakref.WeakKeyDictionary()
# Frames known to hold no row twice.
_unique: "weakref.WeakSet[DataFrame]" = weakref.WeakSet()
_lock = threading.Lock()


@dataclass(frozen=True)
class Sizes:
    """Rows of a written table, and bytes of the values of each text column."""

    rows: int
    bytes: Mapping[str, int]

_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4}


def is_text(kind: str) -> bool:
    return kind == "string" or kind.startswith(("varchar", "char"))


def _width(kind: str) -> int | None:
    """Bytes of a fixed-width type; None for text, binary and nested types."""
    if is_text(kind) or kind == "binary" or kind.startswith(("array", "map", "struct")):
        return None
    return 16 if kind.startswith("decimal") else _FIXED_WIDTH.get(kind, 8)


def _size_terms(df: DataFrame) -> tuple[F.Column, int]:
    """(bytes of the variable-width values of a row, width of its fixed-width
    columns).  Only text, binary and nested columns are read: the fixed
    part is the row count times the width (an upper bound, NULLs included)."""
    fixed, parts = 0, []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        width = _width(kind)
        if width is not None:
            fixed += width
            continue
        c = F.col(f"`{field.name}`")
        size = F.octet_length(F.to_json(c)) if kind.startswith(("array", "map", "struct")) else F.octet_length(c)
        parts.append(F.coalesce(size.cast("long"), F.lit(0).cast("long")))
    return reduce(lambda a, b: a + b, parts, F.lit(0).cast("long")), fixed


def note_superset(df: DataFrame, superset: DataFrame) -> DataFrame:
    """Records that ``superset`` holds every row of ``df`` (a DISTINCT of it):
    its size bounds that of ``df`` and needs no shuffle to be counted."""
    with _lock:
        _supersets[df] = superset
    return df


def note_unique(df: DataFrame) -> DataFrame:
    """Records that no two rows of ``df`` are equal."""
    with _lock:
        _unique.add(df)
    return df


def is_unique(df: DataFrame) -> bool:
    with _lock:
        return df in _unique


def distinct_lookup(df: DataFrame) -> DataFrame:
    """The DISTINCT of a lookup, bounded by what bounds the lookup."""
    with _lock:
        held = _supersets.get(df)
    return df if held is not None else note_superset(df.distinct(), df)


def note_sizes(df: DataFrame, sizes: Sizes) -> DataFrame:
    """Records the sizes of the written table that ``df`` reads whole."""
    with _lock:
        _sizes[df] = sizes
        _bounds[df] = (sizes.rows, sum(sizes.bytes.values()))
    return df


def sizes_of(df: DataFrame) -> Sizes | None:
    with _lock:
        return _sizes.get(df)


def narrowed(df: DataFrame, where: Column | None, *columns: str | tuple[str, str]) -> DataFrame:
    """Filtered rows and picked columns (``name``, or ``(name, alias)``) of a table.

    What is recorded about the table's size bounds the result's: a filter
    leaves at most its rows, a column at most its bytes.
    """
    pairs = [(c, c) if isinstance(c, str) else c for c in columns]
    out = (df if where is None else df.where(where)).select(*[F.col(c).alias(a) for c, a in pairs])
    sizes = sizes_of(df)
    if sizes and all(c in sizes.bytes or _width(df.schema[c].dataType.simpleString()) is not None for c, _ in pairs):
        with _lock:
            _bounds[out] = (sizes.rows, sum(sizes.bytes.get(c, 0) for c, _ in pairs))
    return out


def _bounded(df: DataFrame) -> tuple[int, int] | None:
    """(rows, bytes) that a frame holds at most, by what was recorded."""
    with _lock:
        bound = _bounds.get(_supersets.get(df, df))
    if bound is None:
        return None
    rows, text = bound
    return rows, text + rows * sum(_width(f.dataType.simpleString()) or 0 for f in df.schema.fields)


def proven_small(df: DataFrame, settings: Settings = DEFAULT) -> bool:
    """Whether recorded sizes alone prove that ``df`` may be broadcast."""
    held = _bounded(df)
    return held is not None and held[0] <= settings.broadcast_max_rows and held[1] <= settings.broadcast_max_bytes


def _too_large(df: DataFrame, max_bytes: int) -> bool:
    """Whether the files a frame reads already pass the bound, by the plan's
    estimate.  Asked only of plans that read files and join nothing: a join's
    estimate is a product, and other sources' a guess."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    if "Join " in plan.toString() or any(leaves.apply(i).nodeName() != "LogicalRelation" for i in range(leaves.size())):
        return False
    return int(str(plan.stats().sizeInBytes())) > max_bytes


def bounded_fits(frames: Sequence[DataFrame], max_rows: int, max_bytes: int | None = None) -> list[bool]:
    """For each frame, whether it has at most ``max_rows`` rows and at most
    ``max_bytes`` bytes of values.

    A frame whose recorded size stays within the bound is not counted.  One
    job for all others: the frames are tagged, unioned and summed per
    tag.  The aggregation is partial on every task (one row per frame and
    task) and final on one small row per frame, so no task receives the
    rows of a large frame, and the fact table is never read by a check.
    A DISTINCT is counted by the rows under it, so a check shuffles nothing
    but its sums, and a frame whose files alone pass the bound is not read.
    Where the rows under a DISTINCT pass twice the bound and its own, by an estimate,
    do not pass it, as where a lookup of a few rows is made from a large table, its own
    are counted: to shuffle the fact instead costs far more.
    Without ``max_bytes`` only rows are counted (no column is read).
    """
    bound = (max_rows, max_bytes if max_bytes is not None else -1)
    with _lock:
        known = {i: _checked.get(f) for i, f in enumerate(frames)}
        sources = [_supersets.get(f, f) for f in frames]
    todo = [i for i, k in known.items() if k is None or k[0] != bound]
    for i in list(todo):
        held = _bounded(frames[i])
        if held and held[0] <= max_rows and (max_bytes is None or held[1] <= max_bytes):
            known[i] = (bound, True, held[1])
            with _lock:
                _checked[frames[i]] = known[i]
            todo.remove(i)
    if max_bytes is not None:
        for i in [i for i in todo if _too_large(sources[i], max_bytes)]:
            known[i] = (bound, False, max_bytes + 1)
            with _lock:
                _checked[frames[i]] = known[i]
            todo.remove(i)
    if todo:
        terms = {i: _size_terms(sources[i]) if max_bytes is not None else (F.lit(0).cast("long"), 0) for i in todo}
        tagged = [sources[i].select(F.lit(i).alias("__i"), terms[i][0].alias("__b")) for i in todo]
        stats = {r["__i"]: (r["n"], r["b"] or 0) for r in reduce(DataFrame.unionAll, tagged).groupBy("__i").agg(
            F.count(F.lit(1)).alias("n"), F.sum("__b").alias("b")).collect()}
        with _lock:
            for i in todo:
                n, var_bytes = stats.get(i, (0, 0))
                size = var_bytes + n * terms[i][1]
                fits = n <= max_rows and (max_bytes is None or size <= max_bytes)
                far = n > 2 * max_rows or (max_bytes is not None and size > 2 * max_bytes)
                known[i] = (bound, fits, size if fits or far or sources[i] is frames[i] else -1)
                _checked[frames[i]] = known[i]
    few = [i for i in range(len(frames)) if not known[i][1] and sources[i] is not frames[i]
           and _bounded(frames[i]) is None and known[i][2] >= 0]
    for i in few:
        known[i] = _counted_distinct(frames[i], sources[i], bound)
        with _lock:
            _checked[frames[i]] = known[i]
    return [known[i][1] for i in range(len(frames))]


def _counted_distinct(df: DataFrame, under: DataFrame, bound: tuple[int, int]) -> tuple[tuple[int, int], bool, int]:
    """The check of a DISTINCT of too many rows: an estimate of one row a task
    (off by 5 %), then the count.  The negative size of one that doesn't fit
    says that it was tried."""
    max_rows, max_bytes = bound
    tried = bound, False, -1
    if under.agg(F.approx_count_distinct(F.xxhash64(*[F.col(f"`{c}`") for c in under.columns]))).first()[0] > 1.2 * max_rows:
        return tried
    size, width = _size_terms(df)
    n, var_bytes = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    total = (var_bytes or 0) + n * width
    return (bound, True, total) if n <= max_rows and (max_bytes < 0 or total <= max_bytes) else tried


def checked_bytes(df: DataFrame) -> int:
    """Size in bytes measured by the last check of ``df`` (0 if unchecked
    or checked without a byte bound)."""
    with _lock:
        entry = _checked.get(df)
    return entry[2] if entry else 0


def check_lookups(frames, settings: Settings = DEFAULT) -> None:
    """Run the size checks of every lookup of a build in one job; the joins
    built afterwards from the same frames reuse the results."""
    bounded_fits(list(frames), settings.broadcast_max_rows, settings.broadcast_max_bytes)


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (and ``max_bytes`` bytes)."""
    return bounded_fits([df], max_rows, max_bytes)[0]


@dataclass(frozen=True)
class Lookup:
    """One lookup of a join chain.

    ``broadcast``: ``"auto"`` (size-checked), ``True`` for a side bounded by
    construction (a literal list), ``False`` to never broadcast.  ``met``: the
    rows without a match in it are gone already.
    """

    frame: DataFrame
    on: Column | str | Sequence[str]
    how: str = "inner"
    broadcast: bool | str = "auto"
    met: bool = False


def _key_names(on) -> list[str] | None:
    if isinstance(on, str):
        return [on]
    if isinstance(on, (list, tuple)) and all(isinstance(k, str) for k in on):
        return list(on)
    return None


_SEMI = ("left_semi", "semi", "leftsemi")


def _narrow(lk: Lookup) -> bool:
    """Whether a lookup adds at most one column."""
    return len(set(lk.frame.columns) - set(_key_names(lk.on) or ())) <= 1


def _join_order(columns: Sequence[str], lookups: Sequence[Lookup], broadcast: Sequence[bool]) -> list[int]:
    """Semi joins and the shuffle joins first, each as soon as its key columns exist.

    Joins on named keys that add columns commute as long as a lookup comes
    after the lookups that provide its keys, so the order is free up to
    that.  A shuffle join writes all columns the fact has by then, so those
    that add the fewest come first, and what broadcast joins add comes after
    them, but for the keys that they need and for a single column, which adds
    little and needs no join by the keys alone.  A chain with a join condition
    given as an expression keeps its order.
    """
    keys = [_key_names(lk.on) for lk in lookups]
    if any(k is None for k in keys):
        return list(range(len(lookups)))
    available, pending, order = set(columns), list(range(len(lookups))), []

    def rank(i: int) -> tuple:
        if lookups[i].how in _SEMI:
            return 0, not broadcast[i]
        if broadcast[i]:
            return (0, 2) if _narrow(lookups[i]) else (2, 0)
        return 1, len(lookups[i].frame.columns) - len(keys[i])

    while pending:
        ready = [i for i in pending if set(keys[i]) <= available]
        if not ready:
            return list(range(len(lookups)))
        pick = min(ready, key=rank)
        order.append(pick)
        pending.remove(pick)
        if lookups[pick].how not in _SEMI:
            available |= set(lookups[pick].frame.columns)
    return order


def _with_match(left: DataFrame, lookups: Sequence[Lookup], broadcast: Sequence[bool]) -> DataFrame:
    """The fact rows that have a match in each lookup to be broadcast whose key
    the fact has, before any shuffle; by the keys alone."""
    for lk, small in zip(lookups, broadcast):
        names = _key_names(lk.on)
        if small and lk.how == "inner" and not lk.met and not _narrow(lk) and names and set(names) <= set(left.columns):
            left = left.join(F.broadcast(lk.frame.select(*names)), names, "left_semi")
    return left


def chain_lookups(left: DataFrame, lookups: Sequence[Lookup], settings: Settings = DEFAULT) -> DataFrame:
    """Join ``left`` to each lookup (a star, or a snowflake when a lookup's
    key comes from an earlier one).

    Inner, left outer and left semi joins keep ``left`` as the streamed
    side, so a broadcast right side is always legal.  Lookups under the
    bound are broadcast, smallest first within the chain's broadcast budget;
    the others are shuffle (sort-merge) joins, hinted so that no
    estimate-based threshold of the session broadcasts them.  Before these,
    the fact rows without a match in a broadcast lookup go; the lookup's
    columns are joined after them.
    """
    auto = [lk.frame for lk in lookups if lk.broadcast == "auto"]
    fits = iter(bounded_fits(auto, settings.broadcast_max_rows, settings.broadcast_max_bytes)) if auto else iter(())
    use = [next(fits) if lk.broadcast == "auto" else bool(lk.broadcast) for lk in lookups]
    # keep the chain's broadcasts within the budget: smallest first
    checked = sorted((checked_bytes(lk.frame), i) for i, lk in enumerate(lookups)
                     if use[i] and lk.broadcast == "auto")
    total = 0
    for size, i in checked:
        total += size
        if total > settings.broadcast_budget_bytes:
            use[i] = False
    out = left
    if not all(use) and not settings.audit:  # an audit counts what each join itself loses
        out = _with_match(out, lookups, use)
    for i in _join_order(left.columns, lookups, use):
        lk = lookups[i]
        # a side not proven small is pinned to a shuffle join, so no session's
        # estimate-based threshold can broadcast it
        side = F.broadcast(lk.frame) if use[i] else lk.frame.hint("merge")
        if settings.audit and lk.how == "inner":
            names = _key_names(lk.on) or [str(lk.on)[8:-2]]
            out = settings.audit.joined(out, side, lk.on, f"join on {', '.join(names)}")
        else:
            out = out.join(side, lk.on, lk.how)
    return out


def match_flags(left: DataFrame, lookups: Sequence[tuple[str, Lookup]], settings: Settings = DEFAULT) -> DataFrame:
    """``left`` joined to lookups that may each miss, with a flag column for
    each (its name, then the lookup): true where the row has a match in it.

    One pass over ``left`` tells of every lookup of a star or snowflake, where
    an anti join each would read it as often.  A lookup whose key comes from
    one that missed has no match either.
    """
    checked = iter(bounded_fits([lk.frame for _, lk in lookups], settings.broadcast_max_rows, settings.broadcast_max_bytes))
    out = left
    for (name, lk), fits in zip(lookups, checked):
        side = lk.frame.withColumn(name, F.lit(True))
        out = out.join(F.broadcast(side) if fits else side.hint("merge"), lk.on, "left")
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    return out


def merge_lookups(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Two lookups on one text key as one (inner), for a fact that needs both.

    A fact joined to them one after the other is shuffled by the key once, and
    AQE then splits no hot key, as the second join relies on that
    partitioning.  As one lookup there is one join to split.  The key is
    written anew after the join, so Spark shuffles the merged lookup for the
    fact's join (AQE splits only joins of two shuffles).
    """
    return left.join(right, key).withColumn(key, F.concat(F.col(key), F.lit("")))


def lookup_join(left: DataFrame, right: DataFrame, on: Column | str | Sequence[str],
                how: str = "inner", broadcast: bool | str = "auto",
                settings: Settings = DEFAULT) -> DataFrame:
    """Join a (possibly large) left side to one lookup ``right`` side."""
    return chain_lookups(left, [Lookup(right, on, how, broadcast)], settings)


def semi_join(left: DataFrame, right: DataFrame, on: Column | str | Sequence[str],
              broadcast: bool | str = "auto", settings: Settings = DEFAULT) -> DataFrame:
    """Existence filter: rows of ``left`` with a match in ``right``; ``right``
    adds no column and no duplicate (an inner join under DISTINCT, as a semi join)."""
    return lookup_join(left, right, on, "left_semi", broadcast, settings)
