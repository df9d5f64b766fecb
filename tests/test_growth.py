"""Steps that large ledgers pass once: texts looked at once, large tables read where they lie, and
little of them sent to the driver."""

import pytest
from pyspark.sql import functions as F

from anchorline.functions import predicates as P
from anchorline.functions import scalars as S
from anchorline.operators import filters, signals, sweeps
from anchorline.operators import guards as G
from anchorline.plans import doors, publish
from anchorline.sources import ledger as L
from anchorline.sources.overrides import RULINGS
from builders import LATE, action, ledger, rollup
from builders import START as FIRST
from conftest import SMALL
from workload import tables as T
from workload.tables import START, TODAY, Tables


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_index_runs_each_text_pattern_once_a_row(spark):
    txn = L.normalise_ledger(L.ledger_scan(Tables(spark, SMALL).ledger(), start=START))
    plan = optimized(signals.signal_index(txn, start=START))
    for pattern in ("notice\\s+of\\s+termination", "set\\s+aside", "for\\s+(?:cause"):
        assert plan.count(pattern) == 1, pattern


def test_recency_events_carry_what_their_texts_say(spark):
    txn = sweeps.normalise_sweep(sweeps.sweep_rows(Tables(spark, SMALL).ledger()))
    events = sweeps.events_in_window(txn, start=START, today=TODAY)
    assert optimized(events).count("set\\s+aside") == 1
    found = events.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("reset") == P.is_reset("description")).alias("reset"),
        F.count_if(F.col("signal") == P.is_explicit_termination(START)).alias("signal"),
        F.count_if(F.col("rank") == P.anchor_rank()).alias("rank"),
    ).first()
    assert found["n"] > 0 and len(set(found)) == 1


def test_pieces_are_necessary(spark):
    """Texts at the patterns' edges, odd letters among them, judged as by the pattern alone."""
    texts = [
        "TERMINATED-FOR-CONVENIENCE", "terminatefor conv", "T4C", "\u017ftop-wor\u212a",
        "termination  \u017fettlement", "NOT\u0130CE OF TERM\u0130NATION", "terminated notice",
        "legal contract cancellation", "terminated for cau\u017fe", "terminating for DEFAULT",
        "De-scoped", "PARTIAL TERMINATION", "reduce \u017fcope", "rescind stop work",
        "re\u017fci\u017f\u017fion of suspen\u017fion", "resumption of work, stopwork",
        "cancelled of the stop work", "\u017fet a\u017fide termination", "vacated", "", "offset aside term",
    ]
    from anchorline import vocabulary as V

    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    by = lambda p: F.col("t").rlike(f"(?iuU)(?:{p})")
    subject = by(V.SUBJECT_PATTERN)
    wrong = rows.where(
        (P.is_termination("t") != by(V.TERMINATION_PATTERN))
        | (P.is_cause("t") != by(V.CAUSE_PATTERN))
        | (P.is_descope("t") != by(V.DESCOPE_PATTERN))
        | (P.is_reversal("t") != (subject & by(V.REVERSAL_PATTERN)))
        | (P.is_vacatur("t") != (by(V.VACATUR_PATTERN) | (subject & by(V.SET_ASIDE_PATTERN))))
    )
    assert wrong.collect() == []


def test_large_tables_are_read_where_they_lie(spark, monkeypatch):
    t = Tables(spark, SMALL)
    assert "Repartition" in optimized(t.spread("lineitem"))
    monkeypatch.setattr(T, "BYTES_PER_CORE", 1)
    assert "Repartition" not in optimized(t.spread("lineitem"))
    assert t.spread("lineitem").count() == t.read("lineitem").count()


def test_slots_reach_the_driver_as_bits(spark, monkeypatch):
    """However many keys are wanted, the driver collects one row of 64 slots, not one of each."""
    sent = []
    monkeypatch.setattr(filters.F, "broadcast", lambda df: sent.append(df) or df)
    wanted = spark.range(0, 300_000, 3)
    kept = filters.among(spark.range(300_000), wanted, ["id"])
    assert sent[0].count() <= filters.SLOTS // 64
    assert kept.join(wanted, "id", "left_semi").count() == 100_000
    assert 100_000 < kept.count() < 125_000  # a tenth of the slots are used


@pytest.mark.parametrize("slots", [1, 63, 64, 65, 1000, filters.SLOTS])
def test_rows_of_used_slots_pass_once(spark, slots):
    wanted = spark.createDataFrame(
        [(n * n, None if n % 7 == 0 else f"k{n}") for n in range(40)] * 2, "a long, b string"
    )
    rows = wanted.unionByName(
        spark.createDataFrame([(-n, f"k{n}") for n in range(300)] + [(None, None)] * 2, wanted.schema)
    )
    slot = filters.slot(["a", "b"], slots)
    used = {r[0] for r in wanted.select(slot).collect()}
    expected = sorted(map(str, (r[1:] for r in rows.select(slot, "a", "b").collect() if r[0] in used)))
    kept = filters.among(rows, wanted, ["a", "b"], slots=slots)
    assert sorted(str(tuple(r)) for r in kept.collect()) == expected
    assert kept.columns == ["a", "b"]


def test_missing_award_types_are_not_lower_cased(spark, monkeypatch):
    """Of a missing cell there is no text: with a constant one, as sweeps have, Spark would lower it
    in the driver, where the first call fills the heap."""
    lowered, lower = [], F.lower
    monkeypatch.setattr(S.F, "lower", lambda c: lowered.append(c) or lower(c))
    for missing in (F.lit(None).cast("string"), F.when(F.col("id") > 5, "idv_b")):
        category = S.award_category(missing)
        row = spark.range(1).select(lowered[-1].alias("text"), category.alias("category")).first()
        assert row.text is None and row.category == ""


def test_counts_of_many_awards_send_the_driver_few_rows(spark, staging, monkeypatch):
    """Both doors, the merge, its rulings and the rows the guard counts, over 20,000 awards that all
    stand: what is broadcast on the way does not grow with them."""
    sent = []
    monkeypatch.setattr(filters.F, "broadcast", lambda df: sent.append(df) or df)
    text = "Terminated for convenience of the buyer"
    book = staging.table(ledger(spark, [
        action(n, "2026-06-01", award=n, piid=f"P{n}", generated=f"CONT_AWD_P{n}", code="F", text=text)
        for n in range(20_000)
    ]), "book")
    facts = rollup(spark, [])
    parts = (
        doors.recency_part(book, facts, start=FIRST, today=LATE, staging=staging),
        doors.depth_part(book, facts, start=FIRST, staging=staging),
    )
    rulings = spark.createDataFrame([("P5", "descoped"), ("CONT_AWD_P6", "vacated")], RULINGS)
    made = publish.prepare_terminations(
        *[staging.table(part, "part") for part in parts], rulings, staging=staging
    )
    found = G.row_counts({"terminations": made.terminations, "descoped": made.descoped})
    assert sorted(tuple(r) for r in found.collect()) == [("descoped", 1, True), ("terminations", 19_998, True)]
    assert len(sent) > 2 and max(df.count() for df in sent) <= filters.SLOTS // 64
