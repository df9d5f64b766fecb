"""Text, date, money, identity and URL expressions on hand-made cells."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from anchorline.functions import scalars as S


def evaluate(spark, make, cells):
    """The expression over a column of text cells, in order."""
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r.out for r in frame.select("i", make("c").alias("out")).orderBy("i").collect()]


def check(spark, make, cases):
    cells, wanted = zip(*cases)
    assert evaluate(spark, make, cells) == list(wanted)


def test_as_date(spark):
    check(
        spark,
        S.as_date,
        [
            ("2025-09-02", date(2025, 9, 2)),
            ("2025-09-02T00:00:00", date(2025, 9, 2)),
            ("2025-09-02 10:11:12", date(2025, 9, 2)),
            ("  2025-09-02  ", date(2025, 9, 2)),
            (" 2025-09-02 ", date(2025, 9, 2)),
            ("20250902", date(2025, 9, 2)),
            ("2025-W36-2", date(2025, 9, 2)),
            ("2025W362", date(2025, 9, 2)),
            ("2025-W36", date(2025, 9, 1)),
            ("2020-W53-7", date(2021, 1, 3)),
            ("2021-W53-1", None),
            ("2025-W00-1", None),
            ("2024-02-29", date(2024, 2, 29)),
            ("2025-02-29", None),
            ("2025-13-01", None),
            ("2025-9-2", None),
            ("2025", None),
            ("not-a-date", None),
            ("20250902T1", None),
            ("", None),
            (None, None),
        ],
    )


def test_claim_date(spark):
    check(
        spark,
        S.claim_date,
        [
            ("2025-05-06", date(2025, 5, 6)),
            ("3/4/2025", date(2025, 3, 4)),
            ("03/04/2025", date(2025, 3, 4)),
            (" 12/31/24 ", date(2024, 12, 31)),
            ("1/2/69", date(1969, 1, 2)),
            ("1/2/68", date(2068, 1, 2)),
            ("4-MAR-2025", date(2025, 3, 4)),
            ("04-mar-2025", date(2025, 3, 4)),
            ("2/30/2025", None),
            ("13/1/2025", None),
            ("4-Foo-2025", None),
            ("spring", None),
            (None, None),
        ],
    )


def test_money(spark):
    check(
        spark,
        S.money,
        [
            ("500,000", Decimal("500000.00")),
            (" $1,234.50 ", Decimal("1234.50")),
            ("1E+7", Decimal("10000000.00")),
            ("-5", Decimal("-5.00")),
            ("n/a", None),
            ("$", None),
            ("", None),
            (None, None),
        ],
    )


def test_mod_sort_key(spark):
    check(
        spark,
        S.mod_sort_key,
        [
            ("9", "00000009"),
            ("10", "00000010"),
            ("P00010", "P00000010"),
            ("A-2", "A-00000002"),
            ("123456789", "123456789"),
            ("7b8", "00000007b00000008"),
            ("", ""),
            (None, ""),
        ],
    )
    keys = evaluate(spark, S.mod_sort_key, ["2", "10", "11", "P00009", "P00010"])
    assert keys[0] < keys[1] < keys[2] and keys[3] < keys[4]


def test_codes_keys_and_whitespace(spark):
    check(spark, S.code, [(" idv_c\t", "IDV_C"), (None, ""), ("", "")])
    check(
        spark,
        S.collapse_ws,
        [
            ("one\ntwo\r\n three ", "one two three"),
            ("a  b \x1c c", "a b c"),
            ("  ", ""),
            ("plain words only", "plain words only"),
        ],
    )
    check(
        spark,
        lambda c: S.award_key(c, F.lit("X1")),
        [("CONT_AWD_X1", "CONT_AWD_X1"), ("", "PIID:X1"), (None, "PIID:X1")],
    )
    check(spark, S.is_fallback_key, [("PIID:X1", True), ("CONT_AWD_X1", False)])


def test_award_type(spark):
    cases = [
        ("C", None, True, "contract"), ("A", None, True, "contract"), ("IDV_B_A", None, True, "idv"),
        (" idv_c", None, True, "idv"), ("04", None, False, "grant"), ("", "", False, "grant"),
        (None, None, True, "contract"), (None, "CONT_IDV_77_8000", True, "idv"),
        (None, "cont_idv_77", True, "idv"), (None, "CONT_AWD_77", True, "contract"),
        (None, "ASST_NON_77", False, "grant"), ("C", "CONT_IDV_7", True, "idv"),
        (None, None, None, "grant"),
    ]
    frame = spark.createDataFrame(cases, "t string, g string, f boolean, wanted string")
    wrong = frame.where(S.award_type("t", "g", "f") != F.col("wanted"))
    assert wrong.count() == 0


def test_categories(spark):
    check(
        spark,
        S.award_category,
        [
            ("Definitive Contract", "contract"),
            (" delivery order ", "contract"),
            ("IDV_C", "idv"),
            ("BPA Blanket Purchase Agreement", "idv"),
            ("Cooperative Agreement", "grant"),
            ("loans", ""),
            (None, ""),
        ],
    )


def test_url_ids(spark):
    check(
        spark,
        lambda c: S.url_param(c, "PIID"),
        [
            ("https://x.example/s?a=1&PIID=80J22#f", "80J22"),
            ("https://x.example/s?PIID=8%2F0+J", "8/0 J"),
            ("https://x.example/s?PIID=&PIID=second", "second"),
            ("https://x.example/s?XPIID=1", ""),
            ("https://x.example/no/query", ""),
            ("https://x.example/#?PIID=1", ""),
            ("https://x.example/s?PIID=100%", "100%"),
            ("not a url", ""),
            (None, ""),
        ],
    )
    check(
        spark,
        S.url_path_id,
        [
            ("https://u.example/award/ASST_NON_80K9_8000", "80K9"),
            ("https://u.example/award/CONT_AWD_77_X_8000_-NONE-_-NONE-", "77_X"),
            ("https://u.example/award/80K9/", "80K9"),
            ("https://u.example/award/80K9;v=1?x=/y#z", "80K9"),
            ("https://u.example", ""),
            ("https://u.example//", ""),
            ("award/plain", "plain"),
            (None, ""),
        ],
    )


def test_source_lists(spark):
    check(spark, S.source_count, [("api;mirror", 2), ("api", 1), ("", 0), (";api;", 1)])
    check(spark, lambda c: S.has_source(c, "mirror"), [("api;mirror", True), ("api", False)])
    check(
        spark,
        lambda c: S.join_sources(S.source_parts(c)),
        [("mirror;api;api", "api;mirror"), (";;", "")],
    )


def test_fiscal_year(spark):
    check(
        spark,
        lambda c: S.fiscal_year(S.as_date(c)),
        [("2024-09-30", 2024), ("2024-10-01", 2025), ("2025-01-20", 2025), (None, None)],
    )


def test_effective_end(spark):
    cases = [
        (date(2025, 1, 1), "2026-01-01", date(2025, 1, 1)),
        (None, " 2026-01-01 ", date(2026, 1, 1)),
        (None, "  ", None),
        (None, None, None),
    ]
    frame = spark.createDataFrame(cases, "p date, o string, wanted date")
    wrong = frame.where(~S.effective_end("p", "o").eqNullSafe(F.col("wanted")))
    assert wrong.count() == 0
