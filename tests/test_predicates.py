"""The vocabulary matches what it should, and the prefilters contain the verdict."""

import random
import re
from datetime import date

from pyspark.sql import functions as F

from anchorline import vocabulary as V
from anchorline.functions import predicates as P
from builders import START, day

CASES = {
    P.is_termination: (
        ["TERMINATE FOR CONVIENCE OF BUYER", "terminate forconvenience", "Termination-for-convicne",
         "termination for connivence", "T4C today", "issue stop-work order", "STOP WORK", "stopwork",
         "NOTICE OF  TERMINATION", "terminated notice", "termination settlement offer",
         "LEGAL CONTRACT CANCELLATION", "ſtop work", "termınation settlement",
         "TERMİNATION SETTLEMENT", "notice of termination"],
        ["terminated", "flight termination system battery", "xt4c", "contract cancellation",
         "terminate for cause", "", None],
    ),
    P.is_cause: (
        ["terminated for cause", "TERMINATION FOR DEFAULT", "terminate  for cause per clause"],
        ["terminate for convenience", "for cause", "", None],
    ),
    P.is_descope: (
        ["notice of INTENT TO DESCOPE", "de-scoped", "de scoping", "PARTIAL TERMINATION", "reduce scope"],
        ["TELESCOPE OPERATIONS", "terminate for convenience", "scope", "", None],
    ),
    P.is_reversal: (
        ["rescission of the stop work order", "rescind the termination", "reinstatement, was terminated",
         "resumption of work after the stop-work order", "suspension over, contract reinstated",
         "cancellation of partial stop work notice", "Cancellation of the stop-work order"],
        ["rescind the small business designation", "rescission of an invoice", "cancellation of the award",
         "legal contract cancellation", "terminate for convenience", "", None],
    ),
    P.is_vacatur: (
        ["a court vacated the deal", "VACATUR ENTERED", "termination set aside by the board"],
        ["small business set aside", "evacuate", "", None],
    ),
}


def test_vocabulary(spark):
    for predicate, (hits, misses) in CASES.items():
        frame = spark.createDataFrame(
            [(t, True) for t in hits] + [(t, False) for t in misses], "t string, wanted boolean"
        )
        wrong = [r.t for r in frame.where(predicate("t") != F.col("wanted")).collect()]
        assert not wrong, (predicate.__name__, wrong)


def test_stems_never_hide_a_match(spark):
    """Random texts over the patterns' own pieces: the gated predicate equals the bare pattern."""
    pieces = (
        "terminate terminated termination for cause default convenience conv t4c stop work stopwork "
        "notice of settlement legal contract cancellation cancel descope de-scope partial reduce scope "
        "vacate set aside rescind reinstate resuming suspension TERMİNATION ſuſpension the a"
    ).split() + ["for cause", "for default", "resuming of work"]
    rng = random.Random(4)
    texts = [" ".join(rng.choices(pieces, k=rng.randint(1, 7))) for _ in range(4000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")

    def bare(pattern):
        return F.col("t").rlike(f"(?iuU)(?:{pattern})")

    subject = bare(V.SUBJECT_PATTERN)
    pairs = [
        (P.is_termination("t"), bare(V.TERMINATION_PATTERN)),
        (P.is_cause("t"), bare(V.CAUSE_PATTERN)),
        (P.is_descope("t"), bare(V.DESCOPE_PATTERN)),
        (P.is_reversal("t"), bare(V.REVERSAL_PATTERN) & subject),
        (P.is_vacatur("t"), bare(V.VACATUR_PATTERN) | (bare(V.SET_ASIDE_PATTERN) & subject)),
    ]
    counts = frame.agg(
        *[F.count_if(a != b).alias(f"d{i}") for i, (a, b) in enumerate(pairs)],
        *[F.count_if(b).alias(f"n{i}") for i, (_, b) in enumerate(pairs)],
    ).first()
    assert all(counts[f"d{i}"] == 0 and counts[f"n{i}"] > 0 for i in range(len(pairs)))
    matters = P.may_matter(F.lit(""), "t")
    needed = bare(V.TERMINATION_PATTERN) | bare(V.CAUSE_PATTERN) | pairs[3][1] | pairs[4][1]
    assert frame.where(needed & ~matters).count() == 0
    # And the patterns read as Python's own engine reads them.
    engine = re.compile(V.TERMINATION_PATTERN, re.IGNORECASE)
    hits = {r.t for r in frame.where(P.is_termination("t")).collect()}
    assert hits == {t for t in texts if engine.search(t)}


def test_phrases_are_terminations(spark):
    frame = spark.createDataFrame([(p,) for p in V.SWEEP_PHRASES], "t string")
    assert frame.where(P.is_termination("t") & P.matches_sweep_phrase("t")).count() == len(V.SWEEP_PHRASES)


#: text, code, procurement, day, accepted
VERDICTS = [
    ("admin change", "F", True, "2025-06-01", True),
    ("admin change", "f", True, "2025-06-01", True),
    ("legal contract cancellation", "N", True, "2025-06-01", True),
    ("option three", "N", True, "2025-06-01", False),
    ("termination for convenience", "", False, "2025-06-01", True),
    ("amendment", "F", False, "2025-06-01", False),
    ("terminated for cause", "F", True, "2025-06-01", False),
    ("stop work", "F", True, "2025-01-19", False),
    ("stop work", "F", True, "2025-01-20", True),
    ("terminationforconvenience", "", True, "2025-06-01", True),
    ("intent to descope, stop work", "M", True, "2025-06-01", True),
    ("rescission of the stop work order", "", True, "2025-06-01", True),
    ("purchase of termination receiver", "", True, "2025-06-01", False),
    ("stop work", "F", True, None, False),
]


def verdict_frame(spark):
    return spark.createDataFrame(
        [(t, c, f, "contract" if f else "grant", day(d), w) for t, c, f, d, w in VERDICTS],
        "description string, action_type string, is_fpds boolean, award_type string, "
        "action_date date, wanted boolean",
    )


def test_explicit_termination_and_containment(spark):
    frame = verdict_frame(spark)
    accepted = P.is_explicit_termination(START)
    assert frame.where(accepted != F.col("wanted")).count() == 0
    assert frame.where(accepted & ~P.is_candidate()).count() == 0
    # The prefilter is wider: it keeps text about cause.
    assert frame.where(P.is_candidate() & ~accepted).count() > 0


def test_evidence_and_rank(spark):
    cases = [
        ("contract", "F", "admin", "action_code", 2),
        ("contract", "N", "stop work", "both", 2),
        ("grant", "F", "stop work", "description", 1),
        ("grant", "", "partial termination", "description", 0),
        ("idv", "M", "nothing", "description", 1),
    ]
    frame = spark.createDataFrame(cases, "award_type string, action_type string, description string, d string, r int")
    assert frame.where((P.detected_by() != F.col("d")) | (P.anchor_rank() != F.col("r"))).count() == 0


def test_settled(spark):
    cases = [
        (True, True, False, None, True),
        (True, True, True, None, False),
        (True, True, True, date(2026, 1, 1), True),
        (True, False, False, date(2026, 8, 20), False),
        (False, True, False, date(2020, 1, 1), False),
    ]
    frame = spark.createDataFrame(
        cases,
        "usaspending_found boolean, has_explicit_termination boolean, termination_vacated boolean, "
        "current_end_date date, wanted boolean",
    )
    assert frame.where(P.is_settled(date(2026, 8, 20)) != F.col("wanted")).count() == 0


def test_agency_names(spark):
    cases = [("NASA", True), (" National Aeronautics and Space Administration", True), ("Energy", False), (None, False)]
    frame = spark.createDataFrame(cases, "a string, wanted boolean")
    assert frame.where(P.names_agency("a") != F.col("wanted")).count() == 0
