"""The verdict: scenario histories, random histories against a fold, and a hot key."""

import random
from datetime import date
from random import Random

from pyspark.sql import functions as F

from anchorline.operators import adjudicate as A
from anchorline.operators import guards as G
from anchorline.operators import signals
from anchorline.plans import doors
from anchorline.sources import ledger as L
from anchorline.sources.staging import Staging
from builders import START, action, award, ledger, rollup, txn, txns, values

STOP = "stop work order"
RESCIND = "rescission of the stop work order"
FULL = "termination for convenience"
DESCOPE = "stop work notice, intent to descope"

#: Scenario: rows as (day, code, text, order key), and the row number that stands.
SCENARIOS = {
    "code alone": ([("2025-11-03", "F", "admin", "")], 0),
    "bare N": ([("2025-11-03", "N", "option", "")], None),
    "cause with F": ([("2025-11-03", "F", "terminated for cause", "")], None),
    "rescinded": ([("2025-10-02", "F", STOP, ""), ("2025-10-09", "", RESCIND, "")], None),
    "rescinded, then again": (
        [("2026-01-13", "F", FULL, ""), ("2025-12-12", "", RESCIND, ""), ("2025-11-11", "F", STOP, "")], 0),
    "first of two codes": ([("2026-03-03", "F", "settlement", ""), ("2025-02-02", "F", FULL, "")], 1),
    "code supersedes text": ([("2025-12-24", "F", FULL, ""), ("2025-12-01", "M", STOP, "")], 0),
    "text supersedes de-scope": ([("2026-02-20", "", FULL, ""), ("2025-04-04", "M", DESCOPE, "")], 0),
    "de-scope alone": ([("2025-04-04", "M", DESCOPE, "")], 0),
    "coded de-scope holds": ([("2026-02-20", "", FULL, ""), ("2025-04-28", "F", DESCOPE, "")], 1),
    "vacated": ([("2025-02-14", "F", FULL, ""), ("2026-02-14", "", "termination vacated", "")], None),
    "reversal first": ([("2025-02-10", "", RESCIND, ""), ("2025-02-11", "F", "admin", "")], 1),
    "before the window": ([("2025-01-19", "F", FULL, "")], None),
    "on the window's day": ([("2025-01-20", "F", FULL, "")], 0),
    "same day, rescinded after": (
        [("2025-10-31", "", "rescind the stop work order", "0008"), ("2025-10-31", "F", STOP, "0003")], None),
    "same day, terminated after": (
        [("2025-10-31", "", "rescind the stop work order", "0008"), ("2025-10-31", "F", STOP, "0021")], 1),
    "tie keeps arrival order": (
        [("2025-10-31", "F", STOP, "7"), ("2025-10-31", "", RESCIND, "7")], None),
    "undated reset comes first": ([(None, "", RESCIND, ""), ("2025-08-19", "F", "admin", "")], 1),
    "no termination": ([("2025-08-19", "", "admin", "")], None),
}


def test_scenarios(spark, staging):
    rows, wanted, number = [], {}, 0
    for name, (history, standing) in SCENARIOS.items():
        for i, (when, code, text, order) in enumerate(history):
            rows.append(txn(number, when, code=code, text=text, order=order, key=name))
            if i == standing:
                wanted[name] = number
            number += 1
    for area in (None, staging):
        accepted = A.accept_awards(txns(spark, rows), start=START, staging=area)
        assert {r.award_key: r.ingest_seq for r in accepted.collect()} == wanted


def fold(history):
    """The sequential reading: resets clear, strictly stronger signals replace."""
    anchor = None
    for event in sorted(history, key=lambda e: e["at"]):
        if event["reset"]:
            anchor = None
        elif event["signal"] and (anchor is None or event["rank"] > anchor["rank"]):
            anchor = event
    return anchor


def test_random_histories_equal_a_fold(spark):
    rng = random.Random(7)
    events, wanted = [], {}
    for key in range(3000):
        history = [
            {
                "key": key, "at": at, "reset": rng.random() < 0.2, "signal": rng.random() < 0.5,
                "rank": rng.randint(0, 2),
            }
            for at in rng.sample(range(40), rng.randint(1, 12))
        ]
        events += history
        standing = fold(history)
        if standing:
            wanted[key] = standing["at"]
    frame = spark.createDataFrame(
        [(e["key"], e["at"], e["reset"], e["signal"], e["rank"]) for e in events],
        "key int, at int, reset boolean, signal boolean, rank int",
    )
    found = A.operative_event(
        frame, ["key"], order=F.struct("at"), is_reset=F.col("reset"), is_signal=F.col("signal"),
        rank=F.col("rank"), salts=3,
    )
    assert {r.key: r.at for r in found.collect()} == wanted


def test_a_key_with_a_third_of_all_rows_is_spread(spark):
    frame = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("at"),
        (F.col("id") == 30_000).alias("reset"),
    )
    rows = A.history_rows(
        frame, ["key"], order=F.struct("at"), is_reset=F.col("reset"), is_signal=~F.col("reset"),
        rank=F.lit(1),
    )
    found = A.standing_signal(rows.where("NOT _reset"), rows.where("_reset"), ["key"])
    assert found.where("key = 0").first().at == 30_003
    assert found.count() == 40_001
    # A join on the salted key, so the hot key's rows go to many tasks.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "Window" not in plan


def judged(txn, staging):
    return signals.verdicts(signals.signal_index(txn, start=START), staging=staging)


def checks(txn, staging):
    return signals.index_table(txn, start=START, checked_from=START, staging=staging)[1]


def test_resets_count_only_for_awards_with_a_candidate(spark, staging):
    # Two internal awards share a fallback key; the second one has a reset and no candidate.
    shared = dict(piid="S1", generated=None)
    rows = [
        action(1, "2025-06-01", award=1, code="F", **shared),
        action(2, "2025-07-01", award=2, text="resumption of work after suspension", **shared),
        action(3, "2025-06-01", award=3, piid="S2", generated=None, code="F"),
        action(4, "2025-07-01", award=3, piid="S2", generated=None, text="resumption of work after suspension"),
    ]
    txn_rows = L.normalise_ledger(L.ledger_scan(ledger(spark, rows), start=START))
    accepted = judged(txn_rows, staging)
    assert values(accepted, "award_key", "ingest_seq") == [("PIID:S1", 1)]
    # The same answer by the plain route: history of candidates, then the verdict.
    plain = A.accept_awards(A.candidate_history(txn_rows), start=START)
    assert values(plain, "award_key", "ingest_seq") == [("PIID:S1", 1)]


def test_ledger_rows_are_published_with_their_award_facts(spark, staging):
    rows = [
        action(1, "2025-06-01", code="f", text="admin", type=" idv_c"),
        action(2, "2025-06-01", award=2, piid="B1", generated="", text=FULL),
        action(3, "2025-06-01", award=3, piid="C1", generated="CONT_AWD_C1", code="F",
               awarding_agency_id=97),
    ]
    facts = rollup(spark, [award(1, recipient_location_city_name="Oslo",
                                 recipient_location_congressional_code="04",
                                 pop_congressional_code_current="07", pop_congressional_code="01")])
    scan = L.ledger_scan(ledger(spark, rows), start=START)
    accepted = judged(L.normalise_ledger(scan), staging)
    published = A.publish_rows(L.as_txn(L.with_rollup(accepted, facts)))
    assert values(
        published, "award_key", "award_type", "award_type_code", "action_type", "detected_by",
        "sources", "award_description", "recipient_city", "recipient_district", "pop_district",
    ) == [
        ("CONT_AWD_A1", "idv", "IDV_C", "F", "action_code", "mirror", "relay", "Oslo", "04", "07"),
        ("PIID:B1", "contract", "A", "", "description", "mirror", "", "", "", ""),
    ]


def test_rows_without_any_id_share_a_key_and_are_reported(spark, staging):
    rows = [action(1, "2025-06-01", piid=None, generated=""), action(2, "2025-06-01", generated=None)]
    found = checks(L.normalise_ledger(L.ledger_scan(ledger(spark, rows), start=START)), staging)
    assert found["without any id"] == 1


def test_publish_order(spark):
    from builders import row, rows

    frame = rows(spark, [
        row("B", source="api"), row("A", source="api"), row("C", source="api", when="2026-01-15"),
        row("D", source="api", when=None), row("E", source="api", when="2025-02-01"),
    ])
    assert [r.award_key for r in A.publish_order(frame).collect()] == ["C", "A", "B", "E", "D"]


def test_a_signal_that_is_no_candidate_anchors_with_its_award(spark, staging):
    """A vehicle by its id alone: its coded row is a signal, and another row a candidate."""
    book = [
        action(1, "2025-09-02", generated="CONT_IDV_A1", is_fpds=False, type=None, code="F"),
        action(2, "2025-10-02", generated="CONT_IDV_A1", is_fpds=False, type=None, text=STOP),
        action(3, "2025-09-02", award=2, piid="B1", generated="CONT_IDV_B1", is_fpds=None, type=None, code="F"),
    ]
    history = L.normalise_ledger(L.ledger_scan(ledger(spark, book), start=START))
    fused = judged(history, staging)
    rejoined = A.accept_awards(A.candidate_history(history), start=START)
    assert values(fused, "award_key", "ingest_seq") == values(rejoined, "award_key", "ingest_seq")
    assert values(fused, "ingest_seq") == [(1,)]
    assert checks(history, staging) == {
        "accepted, not candidates": 2, "phrase without termination": 0, "without any id": 0,
    }


def test_publish_order_with_ties_and_nulls(spark):
    rows = [
        txn(1, None, key="B"), txn(2, "2025-07-07", key="C"), txn(3, "2025-07-07", key="A"),
        txn(4, None, key="A"), txn(5, "2025-07-08", key="Z"),
    ]
    ordered = A.publish_order(A.publish_rows(txns(spark, rows).repartition(4)))
    assert [(r.award_key, str(r.action_date)) for r in ordered.collect()] == [
        ("Z", "2025-07-08"), ("A", "2025-07-07"), ("C", "2025-07-07"), ("A", "None"), ("B", "None"),
    ]


def test_one_index_serves_every_later_bound(spark, staging):
    """Verdicts from a later bound read the index alone and equal those of a scan from there."""
    draw = Random(11)
    texts = ["terminated for convenience", STOP, "resumption of work after suspension", "vacated", "more work", "termination for cause"]
    book = [
        action(
            n, f"20{draw.choice([12, 19, 24, 25, 26])}-0{draw.randrange(1, 9)}-11", award=n % 40,
            piid=f"P{n % 40}", generated=draw.choice([None, f"CONT_AWD_P{n % 40}"]),
            code=draw.choice(["", "", "F", "N"]), text=draw.choice(texts),
        )
        for n in range(600)
    ]
    frame = ledger(spark, book)
    first = date(2011, 10, 1)
    index, found = doors.depth_index(frame, start=first, checked_from=START, staging=staging)
    for bound in (first, date(2024, 1, 1), START):
        txn = L.normalise_ledger(L.ledger_scan(frame, start=bound))
        plain = A.accept_awards(A.candidate_history(txn), start=bound)
        later = signals.verdicts(index, start=bound, staging=staging)
        assert values(later, "award_key", "ingest_seq") == values(plain, "award_key", "ingest_seq")
    txn = L.normalise_ledger(L.ledger_scan(frame, start=START))
    wanted = {name: txn.where(check).count() for name, check in G.standing_checks(START).items()}
    assert found == wanted


def test_standing_events_are_found_without_reading_any_text(spark):
    plans = {}

    class Recording(Staging):
        def table(self, df, name):
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
            return super().table(df, name)

    txn = L.normalise_ledger(L.ledger_scan(ledger(spark, [action(1, "2025-06-01", code="F")]), start=START))
    index, _ = signals.index_table(txn, start=START, staging=Recording(spark))
    found = signals.verdicts(index, start=START, staging=Recording(spark))
    for scan in plans["keys"].split("ReadSchema")[1:]:
        assert "row:" not in scan.split("\n")[0]
    with_texts = found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1:]
    assert sum("description:string" in scan.split("\n")[0] for scan in with_texts) == 1
