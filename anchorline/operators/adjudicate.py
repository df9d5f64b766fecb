"""One verdict per award: the operative event of an ordered history with resets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.functions import predicates as P
from anchorline.functions import scalars as S
from anchorline.operators.skew import SALTS, salted_join
from anchorline.schemas import TERMINATION, conform
from anchorline.sources.staging import Staging


def history_order(*, extra: Sequence[str] = ()) -> Column:
    """The total order of an award's history: day, order key, then arrival.

    Undated rows come first, as null fields do. `extra` names columns that rank before the arrival
    number, for unions whose arms arrive one after the other.
    """
    return F.struct(
        "action_date",
        S.blank("sort_key").alias("sort_key"),
        *extra,
        "ingest_seq",
    )


def history_rows(
    events: DataFrame,
    keys: Sequence[str],
    *,
    order: Column,
    is_reset: Column,
    is_signal: Column,
    rank: Column,
    keep: Column | None = None,
    **carry: Column,
) -> DataFrame:
    """The rows a verdict depends on: resets and signals, the event packed beside its place.

    `keep` replaces that filter. `carry` names further columns.
    """
    return events.where(is_reset | is_signal if keep is None else keep).select(
        *keys,
        order.alias("_order"),
        is_reset.alias("_reset"),
        is_signal.alias("_signal"),
        rank.alias("_rank"),
        *[column.alias(name) for name, column in carry.items()],
        F.struct(*events.columns).alias("_row"),
    )


def standing_signal(
    signals: DataFrame, resets: DataFrame, keys: Sequence[str], *, salts: int = SALTS
) -> DataFrame:
    """Per key, of the signals after the last reset, the highest rank, earliest first.

    Both steps are aggregations that combine before they shuffle, and the signals meet
    the last reset in a salted join: no task holds a key's history.
    """
    keys = list(keys)
    last_reset = resets.groupBy(*keys).agg(F.max("_order").alias("_cleared"))
    standing = salted_join(
        signals, last_reset, keys, "left", spread=F.col("_order"), salts=salts
    ).where(F.col("_cleared").isNull() | (F.col("_order") > F.col("_cleared")))
    strongest_first = F.struct((-F.col("_rank")).alias("rank"), "_order")
    return (
        standing.groupBy(*keys)
        .agg(F.min_by("_row", strongest_first).alias("_row"))
        .select("_row.*")
    )


def operative_event(
    events: DataFrame,
    keys: Sequence[str],
    *,
    order: Column,
    is_reset: Column,
    is_signal: Column,
    rank: Column,
    keep: Column | None = None,
    salts: int = SALTS,
    staging: Staging | None = None,
) -> DataFrame:
    """At most one row per key: the signal that stands at the end of its history.

    Read in `order`, a reset clears the anchor, and a signal anchors when nothing
    stands or when its rank is strictly higher. That equals: of the signals after
    the key's last reset, the highest rank, earliest first. Rows that are neither
    cannot change the answer and are dropped first; `keep` is another condition that
    drops no reset and no signal.

    Two branches read the relevant rows; with `staging` they are written once.
    """
    rows = history_rows(
        events, keys, order=order, is_reset=is_reset, is_signal=is_signal, rank=rank, keep=keep
    )
    if staging is not None:
        rows = staging.table(rows, "relevant")
    return standing_signal(rows.where("NOT _reset"), rows.where("_reset"), keys, salts=salts)


def accept_awards(
    txn: DataFrame,
    *,
    start: date,
    order: Column | None = None,
    salts: int = SALTS,
    staging: Staging | None = None,
) -> DataFrame:
    """`operative_event` under the termination vocabulary, per award key.

    `start` bounds which rows may anchor. Resets count whatever their date.
    """
    reset, signal = P.is_reset("description"), P.is_explicit_termination(start)
    return operative_event(
        txn,
        ["award_key"],
        order=history_order() if order is None else order,
        is_reset=reset,
        is_signal=signal,
        rank=P.anchor_rank(),
        keep=P.may_matter() & (reset | signal),
        salts=salts,
        staging=staging,
    )


def candidate_awards(txn: DataFrame, award: str = "internal_award_id") -> DataFrame:
    """The distinct awards with at least one candidate row."""
    return txn.where(P.is_candidate()).select(award).distinct()


def candidate_history(txn: DataFrame, award: str = "internal_award_id") -> DataFrame:
    """Every row of every award that has at least one candidate row."""
    return salted_join(
        txn, candidate_awards(txn, award), [award], "left_semi", spread=F.col("ingest_seq")
    )


def publish_rows(accepted: DataFrame) -> DataFrame:
    """Accepted actions on the published termination columns."""
    flat = accepted.select(
        "*",
        F.col("amount").alias("transaction_amount"),
        F.col("description").alias("transaction_description"),
        *[
            F.col(f"{place}_location.{part}").alias(f"{place}_{part}")
            for place, parts in (
                ("recipient", ("address1", "address2", "city", "state", "zip", "district")),
                ("pop", ("city", "state", "zip", "district")),
            )
            for part in parts
        ],
        P.detected_by().alias("detected_by"),
        F.col("source").alias("sources"),
        F.lit("").alias("override_status"),
    )
    return conform(flat, TERMINATION)


def publish_order(rows: DataFrame) -> DataFrame:
    """Newest action first, missing dates last, then by award key."""
    return rows.orderBy(F.desc_nulls_last("action_date"), F.asc("award_key"))
