"""The key at a position of an order, for columns of any sortable type, without sorting the table.

Edges sampled from the column's own values (text, time, decimals, numbers) split it into ranges; one map-only count tells
which range holds the position, and only that range is looked at again. Null comes last in both directions, and NaN
counts as the largest number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import ranking
from riskloom.session import staged

# ranges of one counting scan, values sampled for their edges, leading characters that an edge of text keeps
RANGES, SAMPLED, EDGE_CHARACTERS = 128, 4096, 64
VALUE = "_value"


def _is_time(kind: T.DataType) -> bool:
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType))


def _plain(value: Column, kind: T.DataType) -> Column:
    """Times go to the driver as text of the session's time zone, and come back by the same rule."""
    return value.cast("string") if _is_time(kind) else value


def literal(value, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


@dataclass
class Place:
    """A value, the rows that sort before it and the rows that hold it."""

    value: object
    before: int
    rows: int


def sampled_edges(values: DataFrame, n: int, kind: T.DataType) -> list:
    """About ``RANGES`` ascending values of a bounded sample; they steer the search and never decide its result."""
    fraction = min(1.0, SAMPLED / max(n, 1))
    edge = F.substring(VALUE, 1, EDGE_CHARACTERS) if isinstance(kind, T.StringType) else F.col(VALUE)
    picked = values.sample(fraction, 17).select(edge.alias("_e")).agg(F.sort_array(F.collect_set("_e")).alias("_e"))
    edges = picked.select(F.transform("_e", lambda e: _plain(e, kind))).first()[0]
    step = max(1, len(edges) // RANGES)
    return edges[::step]


def _between(edges: list, i: int, kind: T.DataType) -> Column:
    """Rows with exactly ``i`` edges at or below their value."""
    low = F.lit(True) if i == 0 else F.col(VALUE) >= literal(edges[i - 1], kind)
    return low if i == len(edges) else low & (F.col(VALUE) < literal(edges[i], kind))


def _within_cells(values: DataFrame, wanted: int, kind: T.DataType) -> Place:
    """The value at a position from its distinct values, ordered by range when they are many."""
    cells = staged(values.groupBy(VALUE).agg(F.count(F.lit(1)).alias("_n")), "position-cells")
    before, n_cells = 0, cells.count()
    while n_cells > ranking.CELLS_PER_RANGE:
        parts = min(-(-n_cells // ranking.CELLS_PER_RANGE) + 1, 2000)
        ranged = cells.repartitionByRange(parts, VALUE).withColumn("_r", F.spark_partition_id())
        ranged = staged(ranged, "position-ranges")
        for r in sorted(ranged.groupBy("_r").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("c")).collect()):
            if wanted < before + r["n"]:
                break
            before += r["n"]
        if r["c"] == n_cells:
            break
        cells, n_cells = ranged.filter(F.col("_r") == r["_r"]).drop("_r"), r["c"]
    upto = F.sum("_n").over(Window.orderBy(VALUE).rowsBetween(Window.unboundedPreceding, 0))
    hit = cells.withColumn("_upto", upto + before).filter(F.col("_upto") > wanted)
    row = hit.agg(F.min(F.struct("_upto", "_n", VALUE)).alias("m")).select("m._upto", "m._n", _plain(F.col(f"m.{VALUE}"), kind)).first()
    return Place(row[2], row[0] - row[1], row[1])


def value_at(df: DataFrame, column: str, position: int, ascending: bool = True) -> Place | None:
    """The value at a 0-based position of one column's order; None beyond the last row."""
    kind = df.schema[column].dataType
    values = df.select(F.col(f"`{column}`").alias(VALUE))
    total, present = values.agg(F.count(F.lit(1)), F.count(VALUE)).first()
    if not 0 <= position < total:
        return None
    if position >= present:
        return Place(None, present, total - present)
    wanted = position if ascending else present - 1 - position
    kept, n, before = values.filter(F.col(VALUE).isNotNull()), present, 0
    found = None
    while found is None and n > ranking.CELLS_PER_RANGE:
        edges = sampled_edges(kept, n, kind)
        edge = F.array(*[literal(e, kind) for e in edges])
        ranged = kept.select(F.size(F.filter(edge, lambda e: e <= F.col(VALUE))).alias("_r"), VALUE) if edges else kept.select(F.lit(0).alias("_r"), VALUE)
        low = _plain(F.min(VALUE), kind)
        counts = ranged.groupBy("_r").agg(F.count(F.lit(1)).alias("n"), (F.min(VALUE) == F.max(VALUE)).alias("one"), low.alias("low"))
        for r in sorted(counts.collect(), key=lambda r: r["_r"]):
            if wanted < before + r["n"]:
                break
            before += r["n"]
        if r["one"]:
            found = Place(r["low"], before, r["n"])
        elif r["n"] > 0.9 * n:
            # edges that hardly split the range: long common prefixes, or a value that most of its rows share
            n = r["n"]
            kept = kept.filter(_between(edges, r["_r"], kind))
            break
        else:
            n = r["n"]
            kept = kept.filter(_between(edges, r["_r"], kind))
    if found is None:
        found = _within_cells(kept, wanted - before, kind)
        found = Place(found.value, found.before + before, found.rows)
    return found if ascending else Place(found.value, present - found.before - found.rows, found.rows)


@dataclass
class Key:
    """The key at a position: one value per column, the rows before it and the rows that share it."""

    values: list
    before: int
    rows: int


def key_at(df: DataFrame, columns: Sequence[str], position: int, ascending: Sequence[bool]) -> Key | None:
    """The key at a position of an order by several columns; later columns are looked at only among equal earlier ones."""
    values, before, kept, rows = [], 0, df.select(*[F.col(f"`{c}`") for c in columns]), 0
    for c, up in zip(columns, ascending):
        place = value_at(kept, c, position - before, up)
        if place is None:
            return None
        values.append(place.value)
        before += place.before
        rows = place.rows
        if rows == 1 and c != columns[-1]:
            # a single row: its other values need no search
            same = kept.filter(F.col(f"`{c}`").eqNullSafe(literal(place.value, df.schema[c].dataType)))
            rest = columns[len(values) :]
            values += list(same.select(*[_plain(F.col(f"`{d}`"), df.schema[d].dataType) for d in rest]).first())
            break
        kept = kept.filter(F.col(f"`{c}`").eqNullSafe(literal(place.value, df.schema[c].dataType)))
    return Key(values, before, rows)


def at_or_after(df: DataFrame, columns: Sequence[str], key: Key, ascending: Sequence[bool]) -> Column:
    """True for the rows that sort at or after the key."""
    out = F.lit(True)
    for c, v, up in reversed(list(zip(columns, key.values, ascending))):
        x, kind = F.col(f"`{c}`"), df.schema[c].dataType
        if v is None:
            out = x.isNull() & out
        else:
            edge = literal(v, kind)
            beyond = (x > edge if up else x < edge) | x.isNull()
            out = beyond | ((x == edge) & out)
    return out
