"""The recency door: sweeps, follow-up, second judgement, award facts by two keys."""

from datetime import date

from anchorline.operators import sweeps
from anchorline.plans import doors
from builders import START, action, award, ledger, rollup, values

TODAY = date(2026, 8, 20)
RESCIND = "rescission of the earlier order, stop work lifted"


def swept(spark, actions):
    return sweeps.normalise_sweep(sweeps.sweep_rows(ledger(spark, actions)))


def judged(spark, staging, actions):
    out = sweeps.followup_rejudge(swept(spark, actions), start=START, today=TODAY, staging=staging)
    return values(out, "award_key", "ingest_seq")


def own(name, **more):
    return dict(piid=name, generated=f"CONT_AWD_{name}", **more)


def test_both_sweeps_and_their_bounds(spark):
    rows = [
        action(1, "2026-07-01", code="F", **own("A")),                           # code
        action(2, "2025-02-01", text="Stop Work order", **own("B")),             # keyword
        action(3, "2026-07-01", code="F", text="T4C", **own("C")),               # both
        action(4, "2025-06-01", code="F", **own("D")),                           # before the lookback
        action(5, "2024-11-01", text="stop work", **own("E")),                   # before the window
        action(6, "2026-08-21", text="stop work", **own("F")),                   # after today
        action(7, "2026-07-01", code="F", is_fpds=False, type="04", piid=None, fain="G",
               generated="ASST_NON_G"),                                          # a code on a grant
        action(8, "2026-07-01", text="terminate for convenince", **own("H")),    # not enumerated
        action(9, "2026-07-01", text="stop work", awarding_agency_id=97, **own("I")),
        action(10, "2026-04-22", code="N", **own("J")),                          # first day of the lookback
    ]
    union = sweeps.sweep_union(swept(spark, rows), start=START, today=TODAY)
    assert values(union, "ingest_seq", "arrival") == [(1, 1), (10, 1), (2, 0), (3, 0), (3, 1)]


def test_a_rescission_no_sweep_can_see_drops_the_award(spark, staging):
    rows = [
        action(1, "2026-06-01", code="F", text="relay", **own("A")),
        action(2, "2026-06-20", text="contract reinstated after suspension", **own("A")),
        # Anchored under the fallback key; its rescission carries a generated id.
        action(3, "2026-06-01", code="F", piid="B", generated=""),
        action(4, "2026-06-20", text="contract reinstated after suspension", **own("B")),
        action(5, "2026-06-01", code="F", **own("C")),
        # Before the earliest anchor: not part of the follow-up.
        action(6, "2026-05-01", code="", text="contract reinstated after suspension", **own("C")),
    ]
    assert judged(spark, staging, rows) == [("CONT_AWD_C", 5)]


def test_a_stronger_row_in_the_follow_up_takes_over(spark, staging):
    rows = [
        action(1, "2025-03-01", text="stop work", **own("A")),
        # Outside the code sweep's lookback, so only the follow-up sees the code.
        action(2, "2025-06-01", code="F", text="ended", **own("A")),
    ]
    assert judged(spark, staging, rows) == [("CONT_AWD_A", 2)]


def test_same_day_modifications_order_by_number(spark, staging):
    rows = [
        action(1, "2026-06-01", code="F", text="stop work", modification_number="9", **own("A")),
        action(2, "2026-06-01", text=RESCIND, modification_number="10", **own("A")),
    ]
    assert judged(spark, staging, rows) == []


def test_anchors_that_share_a_native_id(spark, staging):
    rows = [
        action(1, "2026-06-01", code="F", piid="X", generated="CONT_AWD_X1"),
        action(2, "2026-06-01", code="F", piid="X", generated="CONT_AWD_X2"),
        action(3, "2026-06-20", text="contract reinstated after suspension", piid="X", generated="CONT_AWD_X9"),
    ]
    # The follow-up goes to the last anchor alone.
    assert judged(spark, staging, rows) == [("CONT_AWD_X1", 1)]


def test_facts_by_generated_then_native_id(spark, staging):
    rows = [
        action(1, "2026-06-01", code="F", **own("A")),
        action(2, "2026-06-01", code="F", piid="B", generated=""),
        action(3, "2026-06-01", text="stop work", is_fpds=False, type="04", piid=None, fain="C",
               generated="ASST_NON_C"),
        action(4, "2026-06-01", code="F", **own("D")),
        action(5, "2026-06-01", code="F", **own("E")),
    ]
    facts = rollup(spark, [
        award(1, piid="A", generated="CONT_AWD_A", description="by generated id"),
        award(2, piid="B", generated="CONT_AWD_B", description="by native id", type="b"),
        award(3, piid="C", generated="CONT_AWD_C", description="other type"),
        award(4, piid="D", generated="CONT_AWD_D", description="other agency", awarding_agency_id=97),
        award(5, piid="E", generated="CONT_AWD_E9", description="first of two"),
        award(6, piid="E", generated="CONT_AWD_E8", description="last of two"),
    ])
    part = doors.recency_part(
        ledger(spark, rows), facts, start=START, today=TODAY, staging=staging
    )
    assert values(part, "award_id", "award_description", "award_type_code", "sources") == [
        ("A", "by generated id", "A", "api"), ("B", "by native id", "B", "api"), ("C", "", "", "api"),
        ("D", "", "", "api"), ("E", "last of two", "A", "api"),
    ]


def test_the_recency_door_reads_the_window_of_the_ledger_once(spark, tmp_path):
    """One scan of the ledger, of the window's years; the follow-up reads staged events."""
    from anchorline.sources import ledger as L
    from anchorline.sources.staging import Staging

    rows = [
        action(1, "2026-06-01", code="F", **own("A")),
        action(2, "2026-06-20", text="more of the same", **own("A")),
        action(3, "2019-06-01", code="F", **own("B")),
        action(4, "2026-12-01", code="F", **own("C")),
    ]
    L.write_ledger(ledger(spark, rows), str(tmp_path / "book"))
    plans = []

    class Recording(Staging):
        def table(self, df, name):
            plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
            return super().table(df, name)

    part = doors.recency_part(
        L.read_ledger(spark, str(tmp_path / "book")), rollup(spark, []),
        start=START, today=TODAY, staging=Recording(spark),
    )
    plans.append(("part", part._jdf.queryExecution().executedPlan().toString()))
    assert values(part, "award_id") == [("A",)]
    reading = [(name, plan) for name, plan in plans if "/book" in plan]
    assert [name for name, _ in reading] == ["events"]
    (scan,) = reading[0][1].split("FileScan")[1:]
    years = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "(action_year#" in years and ">= 2025)" in years and "<= 2026)" in years
    assert "GreaterThanOrEqual(action_date,2025-01-20)" in scan
    later = [plan for name, plan in plans if name == "relevant"][0]
    follow_up = [x for x in later.split("FileScan")[1:] if "GreaterThanOrEqual(action_date,2026-06-01)" in x]
    assert len(follow_up) == 1  # since the earliest anchor
    assert "_slot" in later


def test_rows_among_wanted_keys(spark):
    from anchorline.operators.filters import among

    rows = spark.range(1000).selectExpr("id", "CAST(id % 100 AS STRING) AS name").unionByName(
        spark.createDataFrame([(5000, None)], "id long, name string")
    )
    wanted = spark.createDataFrame([("7",), ("8",), ("7",), (None,), ("absent",)], "name string")
    kept = among(rows, wanted, ["name"])
    assert kept.columns == ["id", "name"]
    assert {r.name for r in kept.collect()} == {"7", "8", None}
    assert kept.count() == 21
    crowded = among(rows, wanted, ["name"], slots=1)  # nothing can be dropped
    assert crowded.count() == 1001
    assert among(rows, wanted.limit(0), ["name"]).count() == 0
