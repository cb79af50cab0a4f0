"""Deep pages of the incident list by counts: the range of the sort column that holds a page is narrowed, and only its rows are sorted.

The rows are counted by coarse cells of the sort column; the cells that hold the page are counted again by finer ones, down to single values
and then to prefixes of the id, until few rows are left. Each step is a partial aggregate over two columns, so a page costs a few column
scans at any depth, where an offset alone would carry all rows before the page through every task's heap and the driver.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from alertloom.operators.analytics import SORTS, Filters, check_page, list_columns, sort_order

MOST_ROWS = 10_000
_ID_PREFIXES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)


def _cells(name: str) -> list[Column]:
    """Cells of a sort column, each within one of the level before, the last the value itself."""
    c = F.col(name)
    if name == "created_at":
        return [F.date_trunc(unit, c) for unit in ("day", "hour", "minute", "second")] + [c]
    if name == "confidence":
        return [F.floor(c * 100), F.floor(c * 10_000), c]
    if name == "event_count":
        return [F.expr("event_count div 10000"), F.expr("event_count div 100"), c]
    return [c]


def _levels(name: str) -> list[list[Column]]:
    """Keys of each level: whether the value is null, its cell, and a prefix of the id."""
    cells = _cells(name)
    missing = F.col(name).isNull().cast("int")
    return [[missing, c, F.lit("")] for c in cells] + [[missing, cells[-1], F.substring("id", 1, n)] for n in _ID_PREFIXES]


def _ahead(keys: list[Column], place, ascending: list[bool]) -> Column:
    """Rows that come after ``place`` in the order of the keys, or are at it. A null cell stands alone in its null flag."""
    same, after = F.lit(True), []
    for key, value, up in zip(keys, place, ascending):
        if value is None:
            continue
        after.append(same & ((key > F.lit(value)) if up else (key < F.lit(value))))
        same = same & (key == F.lit(value))
    return F.coalesce(reduce(lambda a, b: a | b, [*after, same]), F.lit(False))


def _narrowed(rows: DataFrame, name: str, order: str, skip: int, size: int, most: int) -> tuple[DataFrame, int] | None:
    """Rows that hold the places ``skip`` to ``skip + size`` of the sorted rows, and how many of them come before; None if there are no such."""
    up = order == "asc"
    ascending = [up, up, True]
    for keys in _levels(name):
        cells = rows.groupBy(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("n"))
        place = Window.orderBy(*[F.col(f"k{i}").asc_nulls_last() if a else F.col(f"k{i}").desc_nulls_last() for i, a in enumerate(ascending)])
        until = F.sum("n").over(place.rowsBetween(Window.unboundedPreceding, 0))
        held = cells.withColumn("until", until).filter((F.col("until") > skip) & (F.col("until") - F.col("n") < skip + size))
        key = F.struct("k0", "k1", "k2")
        found = held.agg(F.min_by(key, "until").alias("first"), F.max_by(key, "until").alias("last"), F.min(F.col("until") - F.col("n")).alias("before"),
                         F.sum("n").alias("n")).first()
        if found["n"] is None:
            return None
        rows = rows.filter(_ahead(keys, found["first"], ascending) & _ahead(keys, found["last"], [not a for a in ascending]))
        skip -= found["before"]
        if found["n"] <= most:
            break
    return rows, skip


def deep_page(incidents: DataFrame, filters: Filters = Filters(), page: int = 1, per_page: int = 20, sort: str = "created_at",
              order: str = "desc", most_rows: int = MOST_ROWS) -> DataFrame:
    """The page that ``list_incidents`` gives, at any depth; at most ``most_rows`` rows are sorted for it (more only where that many
    ids begin with the same 32 characters). A page behind the last one is empty."""
    check_page(per_page, page)
    name = sort if sort in SORTS else "created_at"
    rows = incidents.filter(filters.condition())
    found = _narrowed(rows, name, order, (page - 1) * per_page, per_page, most_rows)
    if found is None:
        return list_columns(incidents.limit(0))
    held, skip = found
    return list_columns(held.orderBy(*sort_order(name, order)).offset(skip).limit(per_page))
