"""Exact quantiles of many columns by bracket selection.

A quantile is one or two order statistics, so no sort and no shuffle of the values is
needed to find it:

1. one aggregation takes, per column, its count and a mergeable rank summary, which
   gives a bracket of two values around every wanted rank;
2. the next scan only counts: the brackets' ends cut a column into cells (below, at and
   between the ends), rows are counted per cell, and the values inside brackets are
   counted one by one. What is exchanged is one row per cell and value, of which a
   bracket holds about ``6 / ACCURACY`` of the rows;
3. the counts say in which cell each wanted rank lies. An end is the value itself;
   inside a bracket the value is picked from its counts. A rank that lies elsewhere
   (the summary is approximate), or brackets that hold more than ``GATHER`` rows,
   cost one more scan over those cells alone, with brackets narrower by the same factor.

The result does not rest on the summary's error: it is found in the counts.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_left

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null, qc

#: Accuracy of the rank summaries: ranks are off by at most n / ACCURACY.
ACCURACY = 20_000
#: Rows inside brackets that may be counted value by value in one scan.
GATHER = 400_000
LARGEST = sys.float_info.max


class _Column:
    """What is known of one column: its count, cell ends and the wanted ranks."""

    def __init__(self, n: int, infinite: int, probs: list[float]):
        self.n, self.infinite, self.ends = n, infinite, []
        self.ranks = sorted({r for p in probs for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}) if n else []
        self.found: dict[int, float] = {}

    def cell(self, value: float) -> int:
        """Cells in order: 2j lies below the end j, 2j + 1 is the end j itself."""
        j = bisect_left(self.ends, value)
        return 2 * j + (j < len(self.ends) and self.ends[j] == value)

    def add(self, ends) -> None:
        self.ends = sorted(set(self.ends) | {float(e) for e in ends if e is not None})

    def open_between(self, low: float, high: float) -> set[int]:
        return {c for c in range(self.cell(low) + 1, self.cell(high)) if c % 2 == 0}

    def value(self, rank: int) -> float:
        v = self.found[rank]
        return math.copysign(math.inf, v) if abs(v) == LARGEST and self.infinite else v


def _brackets(probs) -> list[float]:
    return sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-2.5 / ACCURACY, 2.5 / ACCURACY)})


def _summary(expr: str, probs) -> str:
    return f"percentile_approx({expr}, array({', '.join(f'{p!r}D' for p in probs)}), {ACCURACY})"


def _with_cells(x: DataFrame, columns: list[_Column]) -> DataFrame:
    """``c{i}``: the cell of ``q{i}``, for every column that has ends."""
    used = [i for i, c in enumerate(columns) if c.ends]
    # buckets of -x count the ends at or above x, as Bucketizer's intervals are closed below
    bucketed = Bucketizer(splitsArray=[[-math.inf, *(-e for e in reversed(columns[i].ends)), math.inf] for i in used],
                          inputCols=[f"m{i}" for i in used], outputCols=[f"b{i}" for i in used], handleInvalid="keep")
    out = bucketed.transform(x.select("*", *[(-F.col(f"q{i}")).alias(f"m{i}") for i in used])) if used else x
    cells = []
    for i, c in enumerate(columns):
        if c.ends:
            # j ends lie strictly below the value
            j = f"({len(c.ends)} - CAST(b{i} AS INT))"
            ends = ", ".join(f"{e!r}D" for e in c.ends)
            cells.append(F.expr(f"2 * {j} + IF(q{i} <=> try_element_at(array({ends}), {j} + 1), 1, 0)").alias(f"c{i}"))
        else:
            cells.append(F.lit(0).alias(f"c{i}"))
    return out.select(*[f"q{i}" for i in range(len(columns))], *cells)


def _bracketed(column: _Column, at: dict, probs) -> set[int]:
    """The cells inside the brackets ``at`` around ``probs``."""
    return {c for p in probs for c in column.open_between(at[_brackets([p])[0]], at[_brackets([p])[-1]])}


def _counts(x: DataFrame, columns: list[_Column], listed: dict[int, set[int]], only: bool) -> dict:
    """{(column, cell): {value or None: count}}; values are told apart in the cells
    ``listed``. With ``only`` all other cells are left out."""
    items = []
    for i, c in enumerate(columns):
        if not c.n or (only and not listed.get(i)):
            continue
        inside = F.col(f"c{i}").isin(sorted(listed[i])) if listed.get(i) else F.lit(False)
        item = F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("c"), F.when(inside, F.col(f"q{i}")).alias("v"))
        items.append(F.when(F.col(f"q{i}").isNotNull() & (inside if only else F.lit(True)), item))
    out: dict = {}
    if items:
        rows = (_with_cells(x, columns).select(F.explode(F.array(*items)).alias("r")).where("r IS NOT NULL").select("r.*")
                .groupBy("i", "c", "v").count().collect())     # cells, and at most GATHER values
        for r in rows:
            out.setdefault((r["i"], r["c"]), {})[r["v"]] = r["count"]
    return out


def order_statistics(x: DataFrame, probs: list[float]) -> list[_Column]:
    """The order statistics that the quantiles ``probs`` need, of columns q0, q1, ..."""
    names = x.columns
    wanted = _brackets(probs)
    one = x.selectExpr(*[e for c in names for e in (
        f"count({c})", f"count_if(abs({c}) = {LARGEST!r}D)", _summary(c, wanted))]).first()
    columns = [_Column(one[3 * i], one[3 * i + 1], probs) for i in range(len(names))]
    listed: dict[int, set[int]] = {}
    small = {i for i, c in enumerate(columns) if c.n * len(names) <= GATHER}
    inside = sum(min(c.n, 6 * c.n // ACCURACY + 1) * len(probs) for i, c in enumerate(columns) if i not in small)
    for i, c in enumerate(columns):
        at = dict(zip(wanted, one[3 * i + 2] or []))
        c.add(at.values())
        if i in small:
            listed[i] = set(range(0, 2 * len(c.ends) + 1, 2))
        elif inside <= GATHER:
            listed[i] = _bracketed(c, at, probs)
    todo = {i for i, c in enumerate(columns) if c.n}
    only, below = False, {}
    while todo:
        counts = _counts(x, columns, listed, only)
        missing: dict[tuple[int, int], list[int]] = {}
        for i in list(todo):
            c, cells = columns[i], sorted((k[1], v) for k, v in counts.items() if k[0] == i)
            start = None
            for cell, values in cells:
                size = sum(values.values())
                start = below[i, cell] if only else (start or 0)
                for r in c.ranks:
                    if r in c.found or not start <= r < start + size:
                        continue
                    if cell % 2:
                        c.found[r] = c.ends[cell // 2]
                    elif cell in listed.get(i, ()):
                        at = start
                        for v in sorted(values):
                            at += values[v]
                            if r < at:
                                c.found[r] = v
                                break
                    else:
                        missing.setdefault((i, cell), []).append(r)
                        below[i, cell] = start
                start += size
            if len(c.found) == len(c.ranks):
                todo.discard(i)
        if not todo:
            break
        sizes = {k: sum(counts[k].values()) for k in missing}
        if sum(sizes.values()) <= GATHER:
            listed, only = {}, True
            for i, cell in missing:
                listed.setdefault(i, set()).add(cell)
            continue
        # narrower brackets inside the cells that hold a wanted rank
        centres = {k: [(r - below[k] + 0.5) / sizes[k] for r in rs] for k, rs in missing.items()}
        narrow = _with_cells(x, columns).selectExpr(*[
            _summary(f"IF(c{i} = {cell}, q{i}, NULL)", _brackets(centres[i, cell])) for i, cell in missing]).first()
        inside = sum(min(s, 6 * s // ACCURACY + 1) * len(missing[k]) for k, s in sizes.items())
        listed, only, below = {}, False, {}
        found = {k: dict(zip(_brackets(centres[k]), values)) for k, values in zip(missing, narrow)}
        for (i, _), at in found.items():
            columns[i].add(at.values())
        if inside <= GATHER:
            for k, at in found.items():
                listed.setdefault(k[0], set()).update(_bracketed(columns[k[0]], at, centres[k]))
    return columns


def quantile_arrays(df: DataFrame, columns, probs) -> dict:
    """``{column: [q for each p]}``, linearly interpolated: q = v[floor h] + (h - floor h)
    (v[ceil h] - v[floor h]), h = (n - 1) p; equal to ``percentile``. None without values."""
    columns, probs = list(columns), [float(p) for p in probs]
    if not columns:
        return {}
    numbers = [nan_to_null(qc(c).cast("double")) for c in columns]
    values = [F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(LARGEST)), F.lit(-LARGEST))) for v in numbers]
    x = df.select(*[v.alias(f"q{i}") for i, v in enumerate(values)])
    out = {}
    for name, c in zip(columns, order_statistics(x, probs)):
        out[name] = []
        for p in probs:
            if not c.n:
                out[name].append(None)
                continue
            h = (c.n - 1) * p
            low, high = c.value(math.floor(h)), c.value(math.ceil(h))
            out[name].append(low if low == high else low + (h - math.floor(h)) * (high - low))
    return out
