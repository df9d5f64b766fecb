"""Classifiers as boolean columns.

Those of text look at one row's text. Joined texts would let words of different actions
match together.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from anchorline import vocabulary as V
from anchorline.functions.scalars import ColumnLike, _c, blank, strip


def _holds_any(text: ColumnLike, *sets: str | tuple[str, ...]) -> Column:
    """The lower-cased text contains one of the pieces, or all of one set of pieces."""

    def any_set(lowered: Column) -> Column:
        wanted = [(pieces,) if isinstance(pieces, str) else pieces for pieces in sets]
        found = [reduce(Column.__and__, [lowered.contains(p) for p in pieces]) for pieces in wanted]
        return reduce(Column.__or__, found)

    # A one-element array binds the lower-cased text, so it is computed once per row.
    return F.exists(F.array(F.lower(blank(text))), any_set)


def _matches(text: ColumnLike, pattern: str) -> Column:
    return blank(text).rlike(f"(?iuU)(?:{pattern})")


# Each predicate looks for a necessary substring before it runs a pattern: most texts
# hold none, and the substring search is an order of magnitude cheaper.


def is_termination(text: ColumnLike) -> Column:
    return _holds_any(text, *V.TERMINATION_PIECES) & _matches(text, V.TERMINATION_PATTERN)


def is_cause(text: ColumnLike) -> Column:
    return _holds_any(text, *V.CAUSE_PIECES) & _matches(text, V.CAUSE_PATTERN)


def is_descope(text: ColumnLike) -> Column:
    return _holds_any(text, *V.DESCOPE_PIECES) & _matches(text, V.DESCOPE_PATTERN)


def _has_subject(text: ColumnLike) -> Column:
    return _holds_any(text, *V.SUBJECT_PIECES) & _matches(text, V.SUBJECT_PATTERN)


def _has_reversal(text: ColumnLike) -> Column:
    return _holds_any(text, *V.REVERSAL_PIECES) & _matches(text, V.REVERSAL_PATTERN)


def _is_set_aside(text: ColumnLike) -> Column:
    return _holds_any(text, *V.SET_ASIDE_PIECES) & _matches(text, V.SET_ASIDE_PATTERN)


def is_reversal(text: ColumnLike) -> Column:
    """The text has a word of undoing and, somewhere, what is undone."""
    return _has_subject(text) & _has_reversal(text)


def _is_vacated(text: ColumnLike) -> Column:
    return _holds_any(text, *V.VACATUR_STEMS) & _matches(text, V.VACATUR_PATTERN)


def is_vacatur(text: ColumnLike) -> Column:
    """A vacating word, or "set aside" beside a termination subject."""
    return _is_vacated(text) | (_is_set_aside(text) & _has_subject(text))


def is_reset(text: ColumnLike) -> Column:
    """A reversal or a vacatur: the row clears whatever stood before it, at any date."""
    # Few texts have a word of undoing, so that is looked for first.
    undone = _has_reversal(text) | _is_set_aside(text)
    return (undone & _has_subject(text)) | _is_vacated(text)


def in_window(day: ColumnLike, start: date) -> Column:
    """On or after the bound; a missing date is outside."""
    return F.coalesce(_c(day) >= F.lit(start), F.lit(False))


def _coded(award_type: ColumnLike, action_type: ColumnLike, codes: tuple[str, ...]) -> Column:
    # The code decides for most rows, so it is looked at first.
    return F.upper(blank(action_type)).isin(*codes) & _c(award_type).isin(*V.CODED_AWARD_TYPES)


def has_termination_code(
    award_type: ColumnLike = "award_type", action_type: ColumnLike = "action_type"
) -> Column:
    return _coded(award_type, action_type, V.TERMINATION_CODES)


def has_standalone_code(
    award_type: ColumnLike = "award_type", action_type: ColumnLike = "action_type"
) -> Column:
    return _coded(award_type, action_type, V.STANDALONE_CODES)


def is_explicit_termination(
    start: date,
    *,
    day: ColumnLike = "action_date",
    award_type: ColumnLike = "award_type",
    action_type: ColumnLike = "action_type",
    text: ColumnLike = "description",
    by_text: Column | None = None,
    by_cause: Column | None = None,
) -> Column:
    """In the window, not for cause, and either a standalone code or termination text.

    `by_text` and `by_cause` are what the text says where that has been looked at.
    """
    by_text = is_termination(text) if by_text is None else by_text
    by_cause = is_cause(text) if by_cause is None else by_cause
    return (
        in_window(day, start)
        & (has_standalone_code(award_type, action_type) | by_text)
        & ~by_cause
    )


def detected_by(
    award_type: ColumnLike = "award_type",
    action_type: ColumnLike = "action_type",
    text: ColumnLike = "description",
) -> Column:
    """Which evidence the row carries; "description" when it carries none."""
    coded = has_termination_code(award_type, action_type)
    return (
        F.when(coded & is_termination(text), "both")
        .when(coded, "action_code")
        .otherwise("description")
    )


def anchor_rank(
    award_type: ColumnLike = "award_type",
    action_type: ColumnLike = "action_type",
    text: ColumnLike = "description",
) -> Column:
    """Evidence strength: coded 2, full termination text 1, de-scope text 0."""
    return (
        F.when(has_termination_code(award_type, action_type), 2)
        .when(is_descope(text), 0)
        .otherwise(1)
    )


def is_candidate(
    is_fpds: ColumnLike = "is_fpds",
    action_type: ColumnLike = "action_type",
    text: ColumnLike = "description",
    by_text: Column | None = None,
    by_cause: Column | None = None,
) -> Column:
    """The prefilter: a superset of `is_explicit_termination` that knows no award type.

    It reads normalised actions, so a code that arrived in lower case is in the net too.
    """
    by_text = is_termination(text) if by_text is None else by_text
    by_cause = is_cause(text) if by_cause is None else by_cause
    coded = F.coalesce(_c(is_fpds), F.lit(False)) & F.upper(blank(action_type)).isin(
        *V.TERMINATION_CODES
    )
    return coded | by_text | by_cause


def may_matter(
    action_type: ColumnLike = "action_type", text: ColumnLike = "description"
) -> Column:
    """A termination code, or any substring some pattern needs.

    Rows without either are neither candidates nor resets. One look at the text settles
    that for most rows of a ledger.
    """
    stems = dict.fromkeys(
        V.TERMINATION_STEMS + V.CAUSE_STEMS + V.SUBJECT_STEMS + V.VACATUR_STEMS
    )
    return F.upper(blank(action_type)).isin(*V.TERMINATION_CODES) | _holds_any(text, *stems)


def matches_sweep_phrase(text: ColumnLike = "description") -> Column:
    """Any sweep phrase, as a plain case-insensitive substring."""
    return _holds_any(text, *V.SWEEP_PHRASES)


def names_agency(agency: ColumnLike) -> Column:
    return F.lower(strip(blank(agency))).isin(*V.AGENCY_NAMES)


def is_settled(today: date) -> Column:
    """A published claim row nothing can change any more."""
    ended = F.coalesce(F.col("current_end_date") < F.lit(today), F.lit(False))
    stands = F.col("has_explicit_termination") & ~F.col("termination_vacated")
    return F.col("usaspending_found") & (stands | ended)


def is_descoped() -> Column:
    """A published row that is a partial de-scope. A human ruling decides before the text."""
    ruled = blank("override_status")
    by_text = is_descope("transaction_description") & ~has_standalone_code()
    return (
        F.when(ruled == V.DESCOPED_STATUS, True).when(ruled != "", False).otherwise(by_text)
    )


def looked_at(text: ColumnLike = "description") -> Column:
    """What the text says, each pattern run once: reset, by_text, by_cause.

    A filter on plain columns is pushed below them and runs their patterns again; it stays
    above a generator, which here gives one row per row.
    """
    flags = {"reset": is_reset(text), "by_text": is_termination(text), "by_cause": is_cause(text)}
    return F.inline(F.array(F.struct(*[flag.alias(name) for name, flag in flags.items()])))
