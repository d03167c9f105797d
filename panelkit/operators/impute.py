"""Gap filling inside each entity: last value before, else first value of the entity.

The plain form is one window over the entity. An entity that holds a large
share of all rows would be one task, so rows of such entities are dealt to
stretches of their full order (order keys, then row id), even in rows however
the keys repeat: each stretch is filled on its own, and a small table of its
edges carries the last value forward across stretches.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.session import written
from panelkit.spec import PanelSpec

HOT_ROWS = 2_000_000
MAX_HOT = 50_000
RANGE_ROWS = 100_000  # rows of one task that deals stretches
CUTS = 2  # stretches per ``hot_rows`` rows, unless ``stretch_rows`` says how many rows one holds


def fillable_columns(df: DataFrame, spec: PanelSpec) -> list[str]:
    """Numeric and text columns, label included, keys excluded."""
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.NumericType, T.StringType)) and f.name not in spec.keys()
    ]


def forward_fill(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str], hot_rows: int = HOT_ROWS, stretch_rows: int | None = None
) -> DataFrame:
    """Missing cells take the entity's last value before them."""
    return _fill(df, spec, columns, False, hot_rows, stretch_rows)


def fill_both(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str], hot_rows: int = HOT_ROWS, stretch_rows: int | None = None
) -> DataFrame:
    """Missing cells take the last value before them, or else the first one after."""
    return _fill(df, spec, columns, True, hot_rows, stretch_rows)


def group_impute(df: DataFrame, spec: PanelSpec, hot_rows: int = HOT_ROWS, stretch_rows: int | None = None) -> DataFrame:
    """Fills every numeric and text column within the entity; unchanged if there is no entity column.

    Rows without an entity stay as they are.
    """
    if spec.entity not in df.columns:
        return df
    return fill_both(df, spec, fillable_columns(df, spec), hot_rows, stretch_rows)


def hot_entities(df: DataFrame, spec: PanelSpec, hot_rows: int = HOT_ROWS, stretch_rows: int | None = None) -> tuple[list[tuple], int]:
    """Entities with more than ``hot_rows`` rows, their rows, and the number of stretches to deal them to.

    Only the entity column is read, and counted map-side first. The limit
    rises with the table, so that at most MAX_HOT entities can exceed it.
    """
    sizes = df.where(F.col(spec.entity).isNotNull()).groupBy(spec.entity).agg(F.count("*").alias("rows"))
    total = sizes.agg(F.sum("rows"), F.max("rows")).first()
    limit = max(hot_rows, (total[0] or 0) // MAX_HOT)
    if (total[1] or 0) <= limit:
        return [], 0
    hot = [tuple(r) for r in sizes.where(F.col("rows") > limit).collect()]
    return hot, -(-sum(rows for _, rows in hot) // (stretch_rows or max(1, limit // CUTS)))


def _order(df: DataFrame, spec: PanelSpec) -> list[str]:
    """The order keys, and the row id where they tie."""
    return [*spec.order, *(c for c in spec.present(df, [spec.row_id]) if c not in spec.order)]


def _fill(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str], backward: bool, hot_rows: int, stretch_rows: int | None
) -> DataFrame:
    columns = list(columns)
    hot, stretches = hot_entities(df, spec, hot_rows, stretch_rows)
    if not hot:
        return _fill_plain(df, spec, columns, backward)
    # at most MAX_HOT rows, see hot_entities
    named = F.broadcast(df.sparkSession.createDataFrame([h[:1] for h in hot], T.StructType([df.schema[spec.entity]])))
    plain = _fill_plain(df.join(named, spec.entity, "left_anti"), spec, columns, backward)
    dealt = stretched(df.join(named, spec.entity, "left_semi"), spec, stretches, sum(rows for _, rows in hot))
    return plain.select(*df.columns).unionByName(_fill_stretches(dealt, spec, columns, backward).select(*df.columns))


def stretched(df: DataFrame, spec: PanelSpec, stretches: int, rows: int | None = None) -> DataFrame:
    """The rows with the number of their stretch (``__chunk``): ranges of (entity, full order) that hold about as many rows each.

    ``rows`` is how many rows ``df`` has (counted if not given). A task sorts one range of the order and cuts it into stretches
    by counting, so tasks and files follow the table, not the number of stretches. Written to the shared folder, so that the
    edges and the rows agree on the ranges whatever is computed again.
    """
    order = [spec.entity, *_order(df, spec)]
    rows = df.count() if rows is None else rows
    each = max(1, -(-rows // stretches))
    tasks = max(1, min(stretches, -(-rows // RANGE_ROWS)))
    ranged = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    # the id is the number of the range (from bit 33 on) and the place inside it
    place = F.monotonically_increasing_id()
    number = F.shiftright(place, 33) * F.lit(1 << 33) + F.floor(F.pmod(place, F.lit(1 << 33)) / F.lit(each))
    return written(ranged.withColumn("__chunk", number.cast("long")), "stretches")[0]


def _fill_plain(df: DataFrame, spec: PanelSpec, columns: list[str], backward: bool) -> DataFrame:
    # rows without an entity stay unfilled; spread, they do not end up in one task
    order = _order(df, spec)
    within = W.partitionBy(spec.entity, F.when(F.col(spec.entity).isNull(), F.hash(*order))).orderBy(*order)
    upto = within.rowsBetween(W.unboundedPreceding, 0)
    whole = within.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumns({c: _filled(spec, c, upto, whole if backward else None) for c in columns})


def _filled(spec: PanelSpec, c: str, upto, whole):
    value = F.last(c, ignorenulls=True).over(upto)
    if whole is not None:
        value = F.coalesce(value, F.first(c, ignorenulls=True).over(whole))
    return F.when(F.col(spec.entity).isNull(), F.col(c)).otherwise(value)


def _fill_stretches(rows: DataFrame, spec: PanelSpec, columns: list[str], backward: bool) -> DataFrame:
    """Rows of hot entities, filled: a stretch has one edge row per entity in it, so edges are few beside the rows."""
    keys = _order(rows, spec)
    order = F.struct(*keys)
    edges = rows.groupBy(spec.entity, "__chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"__last_{i}") for i, c in enumerate(columns)],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"__first_{i}") for i, c in enumerate(columns)],
    )
    before = W.partitionBy(spec.entity).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(spec.entity).orderBy("__chunk").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    carried = edges.select(
        spec.entity,
        "__chunk",
        *[F.last(f"__last_{i}", True).over(before).alias(f"__before_{i}") for i in range(len(columns))],
        *[F.first(f"__first_{i}", True).over(every).alias(f"__any_{i}") for i in range(len(columns))],
    )
    upto = W.partitionBy(spec.entity, "__chunk").orderBy(*keys).rowsBetween(W.unboundedPreceding, 0)
    filled = rows.withColumns({f"__upto_{i}": F.last(c, True).over(upto) for i, c in enumerate(columns)})
    filled = filled.join(carried, [spec.entity, "__chunk"])
    return filled.withColumns(
        {
            # where nothing lies before, the entity's first value lies after
            c: F.coalesce(f"__upto_{i}", f"__before_{i}", *([f"__any_{i}"] if backward else []))
            for i, c in enumerate(columns)
        }
    )
