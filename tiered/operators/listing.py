"""Listings, paging, filters, ordered heads and batch change application."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiered import specs


def _check_page(skip: int, limit: int) -> None:
    low, high = specs.PAGE_LIMIT_RANGE
    if skip < 0:
        raise ValueError("skip must be 0 or more")
    if not low <= limit <= high:
        raise ValueError(f"limit must be {low}..{high}")


def list_mart(
    mart: DataFrame,
    key: Sequence[str],
    category: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    skip: int = 0,
    limit: int = 100,
) -> DataFrame:
    """A page of a mart by its key, optionally for a category and period.

    The date filters prune partitions of a stored mart.
    """
    _check_page(skip, limit)
    if category:
        mart = mart.filter(F.col("weather_category") == category)
    if date_from:
        mart = mart.filter(F.col("analysis_date") >= F.lit(date_from).cast("date"))
    if date_to:
        mart = mart.filter(F.col("analysis_date") <= F.lit(date_to).cast("date"))
    return mart.orderBy(*key).offset(skip).limit(limit)


def get_by_id(df: DataFrame, value, key: str = "id") -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def apply_filters(df: DataFrame, filters: Mapping) -> DataFrame:
    """Date range, condition list, severity range and model, all combined.

    A filter that is unset, or whose column is absent, does nothing.
    """
    conds: list[Column] = []
    span = filters.get("date_range")
    if span is not None and len(span) == 2 and "date" in df.columns:
        conds.append(
            F.to_date("date").between(*[F.lit(str(d)).cast("date") for d in span])
        )
    names = filters.get("weather_conditions")
    if names and "weather_condition" in df.columns:
        conds.append(F.col("weather_condition").isin(*names))
    bounds = filters.get("severity_range")
    if bounds is not None and len(bounds) == 2 and "severity_score" in df.columns:
        conds.append(F.col("severity_score").between(*bounds))
    model = filters.get("selected_model")
    if model is not None and model != "All" and "model_name" in df.columns:
        conds.append(F.col("model_name") == model)
    for c in conds:
        df = df.filter(c)
    return df


def top_n_sorted(
    df: DataFrame,
    column: str,
    ascending: bool = True,
    n: int = 100,
    ties: Sequence[str] = (),
) -> DataFrame:
    """First n rows by a column; each task keeps n rows, nothing is fully sorted."""
    if not 10 <= n <= 1000:
        raise ValueError("n must be 10..1000")
    first = F.col(column).asc() if ascending else F.col(column).desc()
    return df.orderBy(first, *ties).limit(n)


def page_of(
    df: DataFrame,
    key: Sequence[str],
    page: int = 1,
    size: int = 20,
    after: Mapping | None = None,
) -> DataFrame:
    """Page ``page`` (1-based) of ``size`` rows in key order.

    A task keeps page * size rows. To walk deep into a large table pass the
    key values of the last row seen as ``after``: the rows up to it are then
    filtered at the scan and every page costs the same.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    if after is not None:
        seen = F.lit(False)
        for k in reversed(list(key)):
            seen = (F.col(k) > F.lit(after[k])) | ((F.col(k) == F.lit(after[k])) & seen)
        df = df.filter(seen)
    return df.orderBy(*key).offset((page - 1) * size).limit(size)


def page_count(df: DataFrame, size: int = 20) -> DataFrame:
    """Total rows and pages."""
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("total_rows"), F.ceil(rows / F.lit(size)).alias("total_pages")
    )


def head_formatted(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str] | None = None,
    formats: Mapping[str, str] | None = None,
    max_rows: int = 100,
) -> DataFrame:
    """First rows of the chosen columns; doubles printed by a printf format."""
    chosen = [c for c in (columns or df.columns) if c in df.columns] or df.columns
    formats = formats or {}
    doubles = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    out = [
        F.when(F.col(c).isNotNull(), F.format_string(formats[c], F.col(c)))
        .otherwise(F.lit(""))
        .alias(c)
        if c in formats and c in doubles
        else F.col(c)
        for c in chosen
    ]
    return df.orderBy(*order).limit(max_rows).select(*out)


def model_listing(models: DataFrame, columns: Sequence[str]) -> DataFrame:
    return models.orderBy(F.desc("training_date"), "id").select(*columns)


def top_features(
    features: DataFrame, model_name: str | None = None, n: int = 15
) -> DataFrame:
    if model_name:
        features = features.filter(F.col("model_name") == model_name)
    return features.orderBy(
        F.desc("importance_score"), "feature_name", "model_name", "model_version"
    ).limit(n)


def latest_active_model(
    models: DataFrame, version: str | None = None, tie: str = "id"
) -> DataFrame:
    """Newest active version of every model, or an exact version of it."""
    active = models.filter("is_active")
    if version is not None:
        active = active.filter(F.col("model_version") == version)
    w = Window.partitionBy("model_name").orderBy(
        F.desc("training_date"), "model_version", tie
    )
    return active.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def collapse_changes(changes: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One row per key from an ordered batch of changes.

    ``changes`` has the key, ``seq``, ``op`` (create, update, delete), the
    fields, and optionally ``sets``, the names of the fields a change sets, by
    which a field can be set to null; without it a change sets the fields that
    are not null. What precedes the last delete or create of a key has no
    effect; after it the last set value of a field wins. The last set value and
    the last reset are kept with their place in the batch, so one aggregate
    that combines before the shuffle is enough: a key with a third of all
    changes is one partial row per task.
    """
    seq, op = F.col("seq"), F.col("op")

    def last_set(f: str) -> Column:
        named = F.col(f).isNotNull()
        if "sets" in changes.columns:
            named = F.when(F.col("sets").isNull(), named).otherwise(
                F.array_contains("sets", f)
            )
        touched = F.when(named & (op != "delete"), seq)
        return F.max_by(F.struct(seq.alias("seq"), F.col(f).alias("value")), touched)

    last = changes.groupBy(key).agg(
        F.max_by(
            F.struct(seq.alias("seq"), op.alias("op")), F.when(op != "update", seq)
        ).alias("__reset"),
        *[last_set(f).alias(f"__last_{f}") for f in fields],
    )
    since = F.col("__reset.seq")
    return last.select(
        key,
        F.col("__reset.op").alias("__reset"),
        *[
            F.when(
                since.isNull() | (F.col(f"__last_{f}.seq") >= since), F.col(f"__last_{f}")
            ).alias(f"__new_{f}")
            for f in fields
        ],
    )


def apply_changes(table: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """The table after a batch of creates, partial updates and deletes.

    An update or delete of an absent row does nothing; a create of a present
    row replaces it, fields it does not set becoming null.
    """
    fields = [c for c in table.columns if c != key]
    batch = collapse_changes(changes, key, fields)
    old = table.withColumn("__present", F.lit(True))
    both = old.join(batch, key, "full_outer")
    created = F.coalesce(F.col("__reset") == "create", F.lit(False))
    kept = F.col("__present").isNotNull() & F.col("__reset").isNull()
    return both.filter(kept | created).select(
        key,
        *[
            F.when(F.col(f"__new_{f}").isNotNull(), F.col(f"__new_{f}.value"))
            .otherwise(F.when(kept, F.col(f)))
            .alias(f)
            for f in fields
        ],
    ).select(*table.columns)
