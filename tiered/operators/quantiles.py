"""Exact quantiles without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
MARGIN = 2 / ACCURACY
# Ranks by which definitions of a quantile and roundings may differ.
RANKS = 4
# The sketch is asked at MARGIN, 2 MARGIN, 4 MARGIN, ... on either side, up to
# the whole range. How far to go follows from the count by arithmetic.
STEPS = 14


def bracket_aggs(probs: Sequence[float]) -> list[Column]:
    """Aggregates that bracket each quantile: a sketch answer on either side.

    The sketch's rank error is at most 1 / ACCURACY of the count; asking it
    MARGIN below and above a quantile, and RANKS further, encloses the exact
    one. The count is not known yet, so a ladder of margins is asked at once.
    """
    asked = [min(max(p + side * m, 0.0), 1.0) for p in probs for side in (-1, 1) for m in _ladder()]
    return [
        F.count("value").alias("n"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile_approx("value", asked, ACCURACY).alias("cuts"),
    ]


def _ladder() -> list[float]:
    return [MARGIN * 2**k for k in range(STEPS)]


def _targets(probs: Sequence[float]) -> Column:
    # The first margin of the ladder that is worth MARGIN and RANKS more.
    need = F.lit(1.0) + F.lit(RANKS / MARGIN) / F.col("n")
    step = F.least(F.ceil(F.log2(need)), F.lit(STEPS - 1)).cast("int")
    margin = F.lit(MARGIN) * F.pow(F.lit(2.0), step)

    def low(i: int, p: float) -> Column:
        cut = F.get(F.col("cuts"), F.lit(2 * i * STEPS) + step)
        return F.when(F.lit(float(p)) <= margin, F.col("min")).otherwise(cut)

    def high(i: int, p: float) -> Column:
        cut = F.get(F.col("cuts"), F.lit((2 * i + 1) * STEPS) + step)
        return F.when(F.lit(float(p)) >= 1 - margin, F.col("max")).otherwise(cut)

    return F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("p"),
                low(i, p).alias("lo"),
                high(i, p).alias("hi"),
            )
            for i, p in enumerate(probs)
        ]
    )


def refine(values: DataFrame, brackets: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles (linear between neighbours) from bracketed values.

    ``brackets`` has one row per column name, so its size is the width of the
    schema and it can be broadcast. Values below a bracket are only counted,
    values above it are dropped, values inside it are counted one by one; the
    ranking window sees the inside values alone, 16 / ACCURACY of the rows and
    a few ranks at most.
    """
    extra = [c for c in brackets.columns if c not in ("column_name", "n", "cuts")]
    targets = brackets.select(
        "column_name", "n", F.struct("n", *extra).alias("stats"),
        _targets(probs).alias("targets"),
    )
    placed = (
        values.join(F.broadcast(targets), "column_name")
        .select("column_name", "n", "stats", "value", F.inline("targets"))
        .filter(F.col("value") <= F.col("hi"))
        .groupBy(
            "column_name",
            "p",
            "n",
            "stats",
            F.when(F.col("value") >= F.col("lo"), F.col("value")).alias("v"),
        )
        .agg(F.count(F.lit(1)).alias("c"))
    )
    w = (
        Window.partitionBy("column_name", "p")
        .orderBy(F.asc_nulls_first("v"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    position = (F.col("n") - 1) * F.col("p")
    lower, upper = F.floor(position), F.ceil(position)
    end = F.col("upto")
    start = end - F.col("c")

    def at(rank: Column) -> Column:
        hit = F.col("v").isNotNull() & (start <= rank) & (rank < end)
        return F.max(F.when(hit, F.col("v")))

    ranked = placed.withColumn("upto", F.sum("c").over(w))
    picked = ranked.groupBy("column_name", "p", "n", "stats").agg(
        at(lower).alias("a"), at(upper).alias("b")
    )
    exact = F.col("a") + (F.col("b") - F.col("a")) * (position - lower)
    outside = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    return picked.select(
        "column_name", "p", F.coalesce(exact, outside).alias("value"), "stats"
    )


#: A bracket with no more values than this is sorted; larger ones are narrowed first.
LIMIT = 4096
# Margins around a quantile that a sketch is asked at; the first fitting one counts.
_MARGINS = (MARGIN, RANKS / LIMIT)


def _present(column: str) -> str:
    """A column as double, null where it is NaN."""
    name = column.replace("`", "``")
    return f"nanvl(CAST(`{name}` AS DOUBLE), NULL)"


def _number(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def _sketch(values: str, asks: Sequence[float]) -> str:
    asked = ", ".join(map(_number, asks))
    return f"percentile_approx({values}, array({asked}), {ACCURACY})"


def _asked(p: float, margin: float) -> list[float]:
    return [max(p - margin, 0.0), min(p + margin, 1.0)]


#: Aggregates of one pass. Beyond spark.sql.codegen.maxFields (100) Spark compiles none.
FIELDS = 80


def _row(df: DataFrame, aggregates: dict[object, str]) -> dict:
    """Row-wise aggregates by key, so many a pass as are compiled; a pass reads its columns.

    They are written as text, as there are thousands of terms for a wide table.
    """
    keys, out = list(aggregates), {}
    for a in range(0, len(keys), FIELDS):
        some = keys[a : a + FIELDS]
        row = df.selectExpr(*[f"{aggregates[k]} AS a{i}" for i, k in enumerate(some)]).first()
        out |= dict(zip(some, row))
    return out


def column_summary(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, dict]:
    """n, mean, std, min, max and the exact quantiles (by p) of columns that have values.

    Passes over the rows are aggregates of many columns side by side; no cell becomes a row
    and nothing is shuffled but partial results. The first ones sketch, which brackets each
    rank. The next count what is below, on and between the ends of each bracket. A bracket
    with more than LIMIT values between its ends is narrowed by a sketch of these alone, as
    often as it takes; then at most LIMIT values a bracket are sorted. Quantiles are linear
    between neighbours; null and NaN are left out.
    """
    asks = [q for p in probs for m in _MARGINS for q in _asked(p, m)]
    plain, sketches = {}, {}
    for c in columns:
        x = _present(c)
        plain |= {
            (c, "n"): f"count({x})", (c, "mean"): f"avg({x})", (c, "std"): f"stddev({x})",
            (c, "min"): f"min({x})", (c, "max"): f"max({x})",
        }
        sketches[c, "cuts"] = _sketch(x, asks)
    # Apart, because a sketch among them would keep the plain ones from being compiled.
    seen = _row(df, plain) | _row(df, sketches)
    out, open_ = {}, {}
    for c in columns:
        if not seen[c, "n"]:
            continue
        out[c] = {k: seen[c, k] for k in ("n", "mean", "std", "min", "max")}
        for i, p in enumerate(probs):
            for rank in {math.floor((out[c]["n"] - 1) * p), math.ceil((out[c]["n"] - 1) * p)}:
                open_[c, rank] = _first_bracket(out[c], seen[c, "cuts"], i, p)
    values = _ranked(df, out, open_)
    for c, stats in out.items():
        for p in probs:
            position = (stats["n"] - 1) * p
            low = values[c, math.floor(position)]
            high = values[c, math.ceil(position)]
            stats[p] = low + (high - low) * (position - math.floor(position)) if high > low else low
    return out


def _first_bracket(stats: dict, cuts: list[float], i: int, p: float) -> tuple[float, float]:
    for k, margin in enumerate(_MARGINS):
        if margin * stats["n"] >= RANKS:
            low, high = cuts[2 * (i * len(_MARGINS) + k) :][:2]
            return (
                stats["min"] if p <= margin else low, stats["max"] if p >= 1 - margin else high
            )
    return stats["min"], stats["max"]


def _ranked(
    df: DataFrame, stats: dict[str, dict], open_: dict[tuple[str, int], tuple[float, float]]
) -> dict[tuple[str, int], float]:
    """The value at each (column, rank), from the bracket that it is thought to be in."""
    found: dict[tuple[str, int], float] = {}
    while open_:
        brackets = {(c, *bounds) for (c, _), bounds in open_.items()}
        counted = {}
        for c, low, high in brackets:
            x, a, b = _present(c), _number(low), _number(high)
            counted |= {
                (c, low, high, "below"): f"count_if({x} < {a})",
                (c, low, high, "low"): f"count_if({x} = {a})",
                (c, low, high, "mid"): f"count_if({x} > {a} AND {x} < {b})",
                (c, low, high, "high"): f"count_if({x} = {b} AND {x} > {a})",
            }
        counts = _row(df, counted)
        sort, narrow, following = {}, {}, {}
        for (c, rank), (low, high) in open_.items():
            below, on, mid, top = (counts[c, low, high, k] for k in ("below", "low", "mid", "high"))
            inside = rank - below - on
            x = _present(c)
            kept = f"CASE WHEN {x} > {_number(low)} AND {x} < {_number(high)} THEN {x} END"
            if rank < below:
                following[c, rank] = (stats[c]["min"], low)
            elif inside < 0:
                found[c, rank] = low
            elif inside < mid and mid <= LIMIT:
                sort[c, low, high] = f"sort_array(collect_list({kept}))"
                found[c, rank] = inside
            elif inside < mid:
                margin = max(MARGIN, RANKS / mid)
                asks = _asked((inside + 0.5) / mid, margin)
                narrow[c, rank] = _sketch(kept, asks)
            elif inside < mid + top:
                found[c, rank] = high
            else:
                following[c, rank] = (high, stats[c]["max"])
        lists = _row(df, sort)
        for (c, rank), bounds in open_.items():
            if (c, rank) in found and (c, *bounds) in sort:
                inside = rank - counts[c, *bounds, "below"] - counts[c, *bounds, "low"]
                if 0 <= inside < counts[c, *bounds, "mid"]:
                    found[c, rank] = lists[c, *bounds][inside]
        following |= {k: tuple(cuts) for k, cuts in _row(df, narrow).items()}
        open_ = following
    return found


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """Rows (column_name, p, value), one a column that has values and a probability."""
    rows = [
        (c, float(p), float(stats[p]))
        for c, stats in column_summary(df, columns, probs).items()
        for p in probs
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, p double, value double")
