"""Profile, defaults, de-duplication, validation and standardising of records.

The order of the steps is part of the result: defaults and required columns,
then one row per key, then coordinates, severity and duration. A bad row can
therefore win its key and be dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiered import specs
from tiered.functions.exprs import (
    in_range_or,
    is_missing,
    ratio_half_up,
    seconds_between,
    to_local_timestamp,
)


def available(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def missing(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def project_available(df: DataFrame, wanted: Sequence[str] = specs.RAW_COLUMNS) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[F.col(f"`{c}`") for c in available(df, wanted)])


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, missing values and their share in percent.

    One aggregate over one scan, whatever the number of columns; the single
    result row is then turned into one row per column.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(is_missing(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                F.col(f"c{i}").alias("null_count"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    share = F.when(
        F.col("__rows") > 0,
        ratio_half_up(F.col("null_count") * 100, F.greatest("__rows", F.lit(1)), 2),
    ).otherwise(F.lit(0))
    return counts.select("__rows", F.inline(entries)).select(
        "column_name",
        "data_type",
        "null_count",
        F.col("__rows").alias("total_rows"),
        share.cast("decimal(5,2)").alias("null_percentage"),
    )


def fill_defaults(df: DataFrame, defaults: Mapping = specs.DEFAULTS) -> DataFrame:
    """Defaults by column; also replaces NaN in doubles. Absent columns are skipped."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.fillna(present) if present else df


def drop_incomplete(df: DataFrame, required: Sequence[str] = specs.REQUIRED) -> DataFrame:
    """Drop rows that lack any required column."""
    for c in available(df, required):
        df = df.filter(F.col(f"`{c}`").isNotNull())
    return df


def dedup_by_key(
    df: DataFrame, key: str = specs.KEY, order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by a declared total order.

    ``row_number() = 1`` plans as WindowGroupLimit, which keeps one row per key
    in every map task before the shuffle, so a key that holds a large share of
    all rows sends one row per task and no more. Flags travel as two bits each,
    where a column of their own would take eight bytes to sort and to shuffle.
    """
    order = list(order) if order is not None else [c for c in df.columns if c != key]
    w = Window.partitionBy(key).orderBy(*[F.col(f"`{c}`") for c in order])
    flags = [
        f.name for f in df.schema
        if isinstance(f.dataType, T.BooleanType) and f.name not in (key, *order)
    ]
    first = pack_flags(df, flags).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    out = unpack_flags(flags)
    return first.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


FLAGS_PER_WORD = 31


def pack_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Flags replaced by words of two bits a flag: 0 false, 1 true, 2 null."""
    words: dict[int, Column] = {}
    for i, c in enumerate(flags):
        word, place = divmod(i, FLAGS_PER_WORD)
        bits = F.coalesce(F.col(f"`{c}`").cast("bigint"), F.lit(2)) * F.lit(1 << 2 * place)
        words[word] = words[word] + bits if word in words else bits
    kept = [F.col(f"`{c}`") for c in df.columns if c not in flags]
    return df.select(*kept, *[bits.alias(f"__flags{w}") for w, bits in words.items()])


def unpack_flags(flags: Sequence[str]) -> dict[str, Column]:
    """The columns that ``pack_flags`` replaced."""
    out = {}
    for i, c in enumerate(flags):
        word, place = divmod(i, FLAGS_PER_WORD)
        bits = F.shiftright(f"__flags{word}", 2 * place).bitwiseAND(F.lit(3))
        out[c] = F.when(bits != 2, bits == 1)
    return out


def geo_valid() -> Column:
    lat, lng = F.col("Start_Lat"), F.col("Start_Lng")
    return lat.between(-90, 90) & lng.between(-180, 180) & (lat != 0) & (lng != 0)


def filter_geo(df: DataFrame) -> DataFrame:
    return df.filter(geo_valid())


def filter_domain(
    df: DataFrame, column: str = "Severity", bounds: tuple[int, int] = specs.SEVERITY_RANGE
) -> DataFrame:
    return df.filter(F.col(column).between(*bounds))


def local_timestamp(df: DataFrame, column: str) -> Column:
    """A column as local timestamp; only text is matched against the pattern."""
    c = F.col(column)
    text = isinstance(df.schema[column].dataType, T.StringType)
    return to_local_timestamp(c) if text else c.cast("timestamp_ntz")


def parse_timestamps(
    df: DataFrame, columns: Sequence[str] = ("Start_Time", "End_Time")
) -> DataFrame:
    """Text to local timestamps in place; unparseable text becomes null."""
    return df.withColumns({c: local_timestamp(df, c) for c in columns})


def duration_hours(start: str = "Start_Time", end: str = "End_Time") -> Column:
    return seconds_between(F.col(start), F.col(end)) / F.lit(3600)


def filter_duration(df: DataFrame, limit: float = specs.MAX_DURATION_HOURS) -> DataFrame:
    """Keep 0 <= Duration_Hours <= limit; a null duration is dropped."""
    return df.filter(F.col("Duration_Hours").between(0, limit))


def standardize_text(
    df: DataFrame,
    trimmed: Sequence[str] = specs.TRIMMED,
    uppered: Sequence[str] = specs.UPPERED,
) -> DataFrame:
    cols = {}
    for c in available(df, trimmed):
        text = F.trim(F.col(c))
        cols[c] = F.upper(text) if c in uppered else text
    return df.withColumns(cols)


def range_or_default(
    df: DataFrame, rules: Sequence[specs.RangeRule] = specs.RANGES
) -> DataFrame:
    """Add the target column of each rule whose source exists."""
    return df.withColumns(
        {
            r.target: in_range_or(F.col(f"`{r.source}`"), r.low, r.high, r.default)
            for r in rules
            if r.source in df.columns
        }
    )


WATERFALL = ("incomplete", "duplicate", "geo", "severity", "duration")


def first_broken_rule(df: DataFrame) -> Column:
    """The first rule a de-duplicated row of the frame breaks, null for a good row."""
    hours = seconds_between(
        local_timestamp(df, "Start_Time"), local_timestamp(df, "End_Time")
    ) / F.lit(3600)
    good_hours = F.coalesce(hours.between(0, specs.MAX_DURATION_HOURS), F.lit(False))
    return (
        F.when(~geo_valid(), F.lit("geo"))
        .when(~F.col("Severity").between(*specs.SEVERITY_RANGE), F.lit("severity"))
        .when(~good_hours, F.lit("duration"))
    )


def _waterfall_rows(totals: DataFrame) -> DataFrame:
    """One row of counts (input and each rule) to one row per step."""
    left = F.col("input")
    rows = [
        F.struct(
            F.lit(0).alias("step"), F.lit("input").alias("rule"),
            F.lit(0).cast("bigint").alias("rows_removed"), left.alias("rows_left"),
        )
    ]
    for i, rule in enumerate(WATERFALL, 1):
        left = left - F.col(rule)
        rows.append(
            F.struct(
                F.lit(i).alias("step"), F.lit(rule).alias("rule"),
                F.col(rule).alias("rows_removed"), left.alias("rows_left"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def quality_waterfall(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in, rows removed by each rule in turn, rows out.

    Every row that survives the required-column rule meets its key group once:
    the group removes ``n - 1`` duplicates and its winner carries the label of
    the first later rule it breaks. Both are aggregates that combine before
    the shuffle, so a hot key costs one partial row per task.
    """
    df = fill_defaults(raw)
    complete = _complete(df)
    label = F.coalesce(first_broken_rule(df), F.lit("kept"))
    per_key = (
        df.select(
            F.when(complete, F.col(specs.KEY)).alias("k"),
            F.struct(*[F.col(c) for c in order], label.alias("label")).alias("row"),
        )
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("winner"))
    )
    has_key = F.col("k").isNotNull()

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    def removed(rule: str) -> Column:
        return total(F.when(has_key & (F.col("winner.label") == rule), 1))

    return _waterfall_rows(
        per_key.agg(
            total(F.col("n")).alias("input"),
            total(F.when(~has_key, F.col("n"))).alias("incomplete"),
            total(F.when(has_key, F.col("n") - 1)).alias("duplicate"),
            *[removed(rule).alias(rule) for rule in WATERFALL[2:]],
        )
    )


def stage(raw: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Unique complete rows with ``rejected_by``, the rule they break or null.

    Written once, this is what the subject tables and the waterfall read; the
    de-duplicating shuffle then runs a single time.
    """
    rows = dedup_by_key(fill_defaults(drop_incomplete(raw)), order=order)
    return rows.withColumn("rejected_by", first_broken_rule(rows))


def standardize_staged(staged: DataFrame) -> DataFrame:
    """The clean table from staged rows."""
    df = staged.filter(F.col("rejected_by").isNull()).drop("rejected_by")
    df = parse_timestamps(df).withColumn("Duration_Hours", duration_hours())
    return range_or_default(standardize_text(df))


def standardize(raw: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Raw records to the one clean table behind the subject tables."""
    return standardize_staged(stage(raw, order))


def staged_waterfall(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """The waterfall from the staged table: counts only, no key is shuffled."""
    counts = raw.select(
        F.lit("raw").alias("part"),
        F.when(_complete(raw), F.lit("complete")).otherwise("incomplete").alias("label"),
    ).unionByName(
        staged.select(
            F.lit("staged").alias("part"),
            F.coalesce("rejected_by", F.lit("kept")).alias("label"),
        )
    ).groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"))

    def total(part: str, label: str | None = None) -> Column:
        hit = F.col("part") == part
        if label is not None:
            hit = hit & (F.col("label") == label)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    return _waterfall_rows(
        counts.agg(
            total("raw").alias("input"),
            total("raw", "incomplete").alias("incomplete"),
            (total("raw", "complete") - total("staged")).alias("duplicate"),
            *[total("staged", rule).alias(rule) for rule in WATERFALL[2:]],
        )
    )


def _complete(df: DataFrame) -> Column:
    out = F.lit(True)
    for c in available(df, specs.REQUIRED):
        out = out & F.col(c).isNotNull()
    return out


def validate_rows(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add ``violations``: the names of the rules a row breaks.

    A condition that comes out null counts as broken; a rule that lets a null
    pass says so itself.
    """
    checks = [
        F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.lit(name))
        for name, cond in rules.items()
    ]
    return df.withColumn("violations", F.array_compact(F.array(*checks)))


def split_valid(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the rules they break."""
    checked = validate_rows(df, rules)
    bad = F.size("violations") > 0
    return checked.filter(~bad).drop("violations"), checked.filter(bad)


def cast_strict(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a schema; overflowing decimals become null."""
    out = []
    for f in schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.try_cast(f.dataType)
        else:
            c = c.cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)
