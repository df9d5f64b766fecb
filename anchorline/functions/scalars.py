"""Text, date, money and identity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from anchorline import vocabulary as V
from anchorline.schemas import MONEY

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text ---------------------------------------------------------------------


def blank(c: ColumnLike) -> Column:
    """Missing text as the empty string."""
    return F.coalesce(_c(c), F.lit(""))


def strip(c: ColumnLike) -> Column:
    """Trim every kind of whitespace, not spaces alone.

    Most cells have none at either end; looking at the two end characters is much
    cheaper than trimming by a character set.
    """
    text = _c(c)
    edge = F.substring(text, 1, 1).isin(*V.WHITESPACE) | F.substring(text, -1, 1).isin(*V.WHITESPACE)
    return F.when(edge, F.btrim(text, F.lit(V.WHITESPACE))).otherwise(text)


def collapse_ws(c: ColumnLike) -> Column:
    """Each run of whitespace as one space, trimmed: one line per cell.

    A single space is left alone, so ordinary text has few replacements.
    """
    space = r"\s\x1c-\x1f"
    runs = rf"(?U) [{space}]+|[{space}&&[^ ]][{space}]*"
    return F.regexp_replace(strip(c), runs, " ")


def code(c: ColumnLike) -> Column:
    """A code in capitals without surrounding white space; a null one is the empty text."""
    return F.upper(strip(blank(c)))


def mod_sort_key(c: ColumnLike) -> Column:
    """Text whose plain order is the order of the numbers inside it.

    Every run of fewer than eight digits gets zeros in front, up to eight; all else stays.
    """
    runs = F.regexp_extract_all(blank(c), F.lit(r"((?U)\d+|\D+)"), F.lit(1))
    padded = F.transform(
        runs,
        lambda run: F.when(
            run.rlike(r"^(?U)\d") & (F.length(run) < 8), F.lpad(run, 8, "0")
        ).otherwise(run),
    )
    return F.array_join(padded, "")


# --- dates --------------------------------------------------------------------


def as_date(c: ColumnLike) -> Column:
    """Text to date: trim, first ten characters, strict ISO; anything else is null.

    Takes the calendar forms 2025-09-02 and 20250902 and the week forms 2025-W36-2,
    2025-W36, 2025W362 and 2025W36.
    """
    head = F.substring(strip(c), 1, 10)
    dashed = F.when(head.rlike(r"^\d{4}-\d\d-\d\d$"), F.try_to_date(head, "yyyy-MM-dd"))
    compact = F.when(head.rlike(r"^\d{8}$"), F.try_to_date(head, "yyyyMMdd"))
    return F.coalesce(dashed, compact, _week_date(head))


def _week_date(text: Column) -> Column:
    """ISO week text to date: the Monday of week one holds or precedes 4 January."""
    shape = r"^(\d{4})(?:-W(\d\d)(?:-([1-7]))?|W(\d\d)([1-7])?)$"
    year = F.regexp_extract(text, shape, 1)

    def digits(dashed: int, compact: int) -> Column:
        return F.concat(F.regexp_extract(text, shape, dashed), F.regexp_extract(text, shape, compact))

    week = digits(2, 4).try_cast("int")
    day = F.coalesce(digits(3, 5).try_cast("int"), F.lit(1))
    fourth = F.try_to_date(F.concat(year, F.lit("-01-04")), "yyyy-MM-dd")
    monday = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth))
    # A week belongs to the year its Thursday falls in; this rejects week 53 of a 52-week year.
    belongs = F.year(F.date_add(monday, 3)) == year.try_cast("int")
    return F.when(text.rlike(shape) & (week >= 1) & belongs, F.date_add(monday, day - 1))


def claim_date(c: ColumnLike) -> Column:
    """A claim's date: ISO first, then m/d/yyyy, m/d/yy, d-Mon-yyyy.

    A day of one digit may be padded with a blank.
    """
    text = F.regexp_replace(strip(c), r"/ (?=[1-9]/)", "/")
    day = r"(?:3[01]|[12]\d|0[1-9]|[1-9])"
    month = r"(?:1[0-2]|0[1-9]|[1-9])"
    long_us = F.when(text.rlike(rf"^{month}/{day}/\d{{4}}$"), F.try_to_date(text, "M/d/yyyy"))
    # Two-digit years pivot at 69: 69-99 are the 1900s, 00-68 the 2000s.
    century = F.when(F.substring(text, -2, 2) >= "69", "19").otherwise("20")
    widened = F.concat(F.regexp_replace(text, r"\d\d$", ""), century, F.substring(text, -2, 2))
    short_us = F.when(text.rlike(rf"^{month}/{day}/\d\d$"), F.try_to_date(widened, "M/d/yyyy"))
    named = F.when(
        text.rlike(rf"^{day}-[A-Za-z]{{3}}-\d{{4}}$"), F.try_to_date(text, "d-MMM-yyyy")
    )
    return F.coalesce(as_date(c), long_us, short_us, named)


def fiscal_year(c: ColumnLike) -> Column:
    """The fiscal year a date falls in: October opens the next one."""
    d = _c(c)
    return F.year(d) + F.when(F.month(d) >= 10, 1).otherwise(0)


def effective_end(period_end: ColumnLike, ordering_end: ColumnLike) -> Column:
    """The performance end date, else the ordering period's end, which arrives as text."""
    return F.coalesce(_c(period_end), F.to_date(F.nullif(F.trim(_c(ordering_end)), F.lit(""))))


# --- money --------------------------------------------------------------------


def money(c: ColumnLike) -> Column:
    """A money cell as decimal: `$` and `,` dropped, unreadable or blank as null."""
    text = F.regexp_replace(strip(_c(c).cast("string")), "[$,]", "")
    return F.nullif(text, F.lit("")).try_cast(MONEY)


# --- identity -----------------------------------------------------------------


def native_id(contract_id: ColumnLike, assistance_id: ColumnLike, uri: ColumnLike) -> Column:
    """The first id present; an empty string counts as present."""
    return F.coalesce(_c(contract_id), _c(assistance_id), _c(uri))


def award_key(generated: ColumnLike, native: ColumnLike) -> Column:
    """The generated id, else the native id in a key space of its own."""
    prefix = F.lit(V.FALLBACK_KEY_PREFIX)
    return F.coalesce(F.nullif(_c(generated), F.lit("")), F.concat(prefix, blank(native)))


def is_fallback_key(key: ColumnLike) -> Column:
    return _c(key).startswith(V.FALLBACK_KEY_PREFIX)


def award_type(type_code: ColumnLike, generated: ColumnLike, is_fpds: ColumnLike) -> Column:
    """idv by type code or generated id, else contract for procurement, else grant."""
    return clean_award_type(code(type_code), code(generated), is_fpds)


def clean_award_type(
    type_code: ColumnLike, generated: ColumnLike, is_fpds: ColumnLike
) -> Column:
    """`award_type` of cells that are trimmed and upper-cased already."""
    by_code = _c(type_code).startswith(V.IDV_TYPE_PREFIX)
    by_id = _c(generated).startswith(V.IDV_ID_PREFIX)
    procurement = F.coalesce(_c(is_fpds), F.lit(False))
    return F.when(by_code | by_id, "idv").when(procurement, "contract").otherwise("grant")


def award_category(c: ColumnLike) -> Column:
    """The contract/idv/grant category of a type code or type description, else blank."""
    pairs = [
        F.lit(cell)
        for category, names in V.AWARD_CATEGORIES.items()
        for name in names
        for cell in (name, category)
    ]
    # A missing cell stays null up to here: lower() of a blank constant runs in the driver, and the
    # first such call there makes gigabytes of garbage (Spark loads the title case of all letters).
    return blank(F.try_element_at(F.create_map(*pairs), F.lower(strip(c))))


def sweep_award_type(
    type_code: ColumnLike, type_text: ColumnLike, generated: ColumnLike, default: ColumnLike
) -> Column:
    """The award type of a sweep row, which may carry a code, a description or neither.

    `generated` is trimmed and upper-cased.
    """
    category = F.coalesce(
        F.nullif(award_category(type_code), F.lit("")),
        F.nullif(award_category(type_text), F.lit("")),
        _c(default),
    )
    return clean_award_type(F.lit(""), generated, category != "grant")


def location(
    city: ColumnLike,
    state: ColumnLike,
    zip_code: ColumnLike,
    district: ColumnLike,
    address1: ColumnLike | None = None,
    address2: ColumnLike | None = None,
) -> Column:
    """A place as one struct; a place of performance has no street lines."""
    return F.struct(
        (F.lit("") if address1 is None else blank(address1)).alias("address1"),
        (F.lit("") if address2 is None else blank(address2)).alias("address2"),
        blank(city).alias("city"),
        blank(state).alias("state"),
        blank(zip_code).alias("zip"),
        blank(district).alias("district"),
    )


def empty_location() -> Column:
    return location(F.lit(""), F.lit(""), F.lit(""), F.lit(""))


# --- source lists (`;`-joined) --------------------------------------------------


def source_parts(c: ColumnLike) -> Column:
    """The non-empty names in a `;`-joined source list."""
    return F.filter(F.split(_c(c), ";"), lambda part: part != "")


def join_sources(parts: ColumnLike) -> Column:
    """An array of source names as the published text: distinct, sorted, `;`-joined."""
    return F.array_join(F.array_sort(F.array_distinct(_c(parts))), ";")


def source_count(c: ColumnLike) -> Column:
    return F.size(source_parts(c))


def has_source(c: ColumnLike, name: str) -> Column:
    return F.array_contains(F.split(_c(c), ";"), name)


# --- URLs -----------------------------------------------------------------------


def url_param(url: ColumnLike, name: str) -> Column:
    """The first non-blank value of a query parameter, decoded; blank when there is none.

    A percent sign without two hexadecimal digits stands for itself.
    """
    query = F.regexp_extract(blank(url), r"^[^?#]*\?([^#]*)", 1)
    raw = F.regexp_extract(query, rf"(?:^|&){name}=([^&]+)", 1)
    return F.url_decode(F.regexp_replace(raw, "%(?![0-9A-Fa-f]{2})", "%25"))


def url_path_id(url: ColumnLike) -> Column:
    """The last path segment, or the native id inside it when it is a composite id."""
    path = F.regexp_extract(
        blank(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1
    )
    plain = F.regexp_replace(path, r";[^/]*$", "")
    segment = F.regexp_extract(plain, r"([^/]+)/*$", 1)
    inner = F.regexp_extract(segment, V.COMPOSITE_ID_PATTERN, 1)
    return F.coalesce(F.nullif(inner, F.lit("")), segment)
