"""The signal index: a ledger's resets, signals and candidates, classified once.

Texts are looked at in one pass, which writes a narrow row per event: its key, its place in the
history, what it is and how strong. Verdicts from any later bound read those columns alone;
the event itself, texts included, lies beside them and is read for the events that stand.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.functions import predicates as P
from anchorline.operators.adjudicate import history_order
from anchorline.operators.filters import among
from anchorline.operators.guards import standing_checks
from anchorline.operators.skew import SALTS, salted_join
from anchorline.sources.staging import Staging

def signal_index(txn: DataFrame, *, start: date) -> DataFrame:
    """Events of `txn` that a verdict from `start` or later may depend on.

    Columns: award_key, award (the internal id), day, place (the order of history), event (a
    number per row), reset, signal, candidate, rank; and `row`, the action itself.
    """
    said = {"by_text": F.col("by_text"), "by_cause": F.col("by_cause")}
    candidate, signal = P.is_candidate(**said), P.is_explicit_termination(start, **said)
    events = txn.where(P.may_matter()).select("*", P.looked_at())
    return events.where(candidate | F.col("reset") | signal).select(
        "award_key",
        F.col("internal_award_id").alias("award"),
        F.col("action_date").alias("day"),
        history_order().alias("place"),
        F.monotonically_increasing_id().alias("event"),
        "reset",
        signal.alias("signal"),
        candidate.alias("candidate"),
        P.anchor_rank().alias("rank"),
        F.struct(*txn.columns).alias("row"),
    )


def judged_events(index: DataFrame, *, salts: int = SALTS) -> DataFrame:
    """Resets and signals of internal awards with a candidate, narrow columns alone.

    A candidate is its own proof, so only the others, which are few, look for one in a join.
    """
    rows = index.drop("row")
    events, awards = rows.where("reset OR signal"), rows.where("candidate").select("award")
    others = events.where("NOT candidate")
    brought_back = salted_join(
        others, among(awards, others, ["award"]).distinct(), ["award"], "left_semi",
        spread=F.col("event"), salts=salts,
    )
    return events.where("candidate").unionByName(brought_back)


def standing_events(
    index: DataFrame, *, start: date | None = None, salts: int = SALTS, staging: Staging
) -> DataFrame:
    """At most one event per award key: the signal that stands at the end of its history, from
    `start` or of the whole index, read from the index's narrow columns.

    Of a key's signals after its last reset the highest rank stands, the earliest first. One
    aggregation gives each key its last reset and the strongest of all its signals. Where that
    signal lies after the reset it stands; for the few other keys the signals after the reset
    are aggregated again.
    """
    rows = index if start is None else index.where(F.col("day") >= F.lit(start))
    events = judged_events(rows, salts=salts)
    strength = F.struct((-F.col("rank")).alias("rank"), "place", "event")
    keys = staging.table(
        events.groupBy("award_key").agg(
            F.max(F.when(F.col("reset"), F.col("place"))).alias("cleared"),
            F.min(F.when(~F.col("reset"), strength)).alias("best"),
        ),
        "keys",
    )
    stands = F.col("cleared").isNull() | (F.col("best.place") > F.col("cleared"))
    settled = keys.where(F.col("best").isNotNull() & stands).select("award_key", "best.event")
    open_ = keys.where(F.col("best").isNotNull() & ~stands).select("award_key", "cleared")
    signals = events.where("NOT reset").select("award_key", "place", "event", "rank")
    later = (
        salted_join(
            among(signals, open_, ["award_key"]), open_, ["award_key"], "inner",
            spread=F.col("event"), salts=salts,
        )
        .where(F.col("place") > F.col("cleared"))
        .groupBy("award_key")
        .agg(F.min(strength).alias("best"))
        .select("award_key", "best.event")
    )
    return settled.unionByName(later)


def verdicts(
    index: DataFrame, *, start: date | None = None, salts: int = SALTS, staging: Staging
) -> DataFrame:
    """The standing events of the index, from `start` or of all of it, as the actions they are.

    Their rows come back by event number: at most one per award. The others mostly stay where
    they lie, as standing numbers' slots limit the read.
    """
    standing = staging.table(
        standing_events(index, start=start, salts=salts, staging=staging).select("event"),
        "standing",
    )
    rows = index.select("event", "row")
    return among(rows, standing, ["event"]).join(standing, "event").select("row.*")


def index_table(
    txn: DataFrame, *, start: date, checked_from: date | None = None, staging: Staging
) -> tuple[DataFrame, dict[str, int]]:
    """The index of `txn` written, and what each standing check finds from `checked_from` on.

    The counts are metrics of the same pass over the ledger; none are taken without a bound.
    """
    if checked_from is None:
        return staging.table(signal_index(txn, start=start), "signals"), {}
    counts = {name: F.count_if(check) for name, check in standing_checks(checked_from).items()}
    observed, found = staging.observed(txn, **counts)
    index = staging.table(signal_index(observed, start=start), "signals")
    return index, found()
