"""The wide feature table: one row per client from the application table and its histories."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskloom.functions import constants as K
from riskloom.operators import aggregation, cleaning, features


@dataclass(frozen=True)
class History:
    """One child table: its prefix, categorical columns, recent window and row-level preparation."""

    table: DataFrame
    prefix: str
    categories: Sequence[str] = ()
    recent: tuple[str, int] | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None


def history_features(
    base: DataFrame, history: History, key: str = K.ID, funcs: Sequence[str] = K.NUMERIC_AGGREGATES,
    max_categories: int = K.MAX_CATEGORIES, skip: Sequence[str] = K.KEY_COLUMNS,
) -> DataFrame:
    """Lifetime, categorical and recent aggregates of one child table."""
    rows = history.prepare(history.table) if history.prepare else history.table
    recent = history.recent if history.recent and history.recent[0] in rows.columns else None
    return aggregation.aggregate_history(
        rows, key, history.prefix, history.categories, recent, funcs, max_categories, skip, parents=base
    )


def build(
    base: DataFrame,
    histories: Sequence[History],
    bureau: tuple[DataFrame, DataFrame] | None = None,
    bureau_key: str = "SK_ID_BUREAU",
    bureau_categories: Sequence[str] = (),
    balance_categories: Sequence[str] = (),
    key: str = K.ID,
    clean: bool = True,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Cleaned base, all histories attached on one partitioning of the key, then derived columns.

    Every history is reduced to one row per client before its join, and all parts are already
    partitioned by the key from their aggregation, so the joins add no shuffle of their own.
    ``ids`` may name a cheaper source of the known keys than the base itself.
    """
    wide = cleaning.sanitize(base) if clean else base
    known = (base if ids is None else ids).select(key)
    parts = []
    if bureau is not None:
        loans, balances = bureau
        parts.append(
            aggregation.roll_up(
                known, loans, balances, key, bureau_key, "BUREAU", "BB", bureau_categories, balance_categories
            )
        )
    parts += [history_features(known, h, key) for h in histories]
    joined = aggregation.attach(wide, parts, key)
    derived = features.add_ratios(joined)
    derived = features.add_presence_flags(derived)
    return features.add_external_score_stats(derived)
