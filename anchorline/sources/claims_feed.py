"""Landed claim pages: one JSON document per page, two kinds of claim."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorline.functions import predicates as P
from anchorline.functions import scalars as S

_TEXT = T.StringType()


def _page_schema(key: str, item_fields: str) -> T.StructType:
    item = T.StructType([T.StructField(name, _TEXT) for name in item_fields.split()])
    return T.StructType(
        [
            T.StructField("success", T.BooleanType()),
            T.StructField("page", T.IntegerType()),
            T.StructField("meta", T.StructType([T.StructField("pages", T.IntegerType())])),
            T.StructField("result", T.StructType([T.StructField(key, T.ArrayType(item))])),
        ]
    )


#: Page documents as landed. `page` is the requested page number, added on landing.
CONTRACT_PAGE = _page_schema(
    "contracts", "agency vendor value savings deleted_date fpds_status fpds_link description"
)
GRANT_PAGE = _page_schema("grants", "agency recipient value savings date link")


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed pages of one kind, one document per line. A line that is none of the schema is kept
    as it came in `unreadable`, for the guard to see."""
    columns = T.StructType([*schema.fields, T.StructField("unreadable", _TEXT)])
    return spark.read.schema(columns).option("columnNameOfCorruptRecord", "unreadable").json(path)


def _trimmed(name: str):
    return S.strip(S.blank(f"item.{name}"))


def contract_claims(pages: DataFrame) -> DataFrame:
    """Contract items in scope, on the claim columns."""
    items = pages.select(F.explode("result.contracts").alias("item"))
    return items.where(P.names_agency("item.agency")).select(
        F.lit("contract").alias("claim_type"),
        S.url_param("item.fpds_link", "PIID").alias("doge_award_id"),
        _trimmed("vendor").alias("recipient"),
        S.money("item.value").alias("doge_value"),
        S.money("item.savings").alias("doge_savings"),
        S.claim_date("item.deleted_date").alias("doge_claim_date"),
        _trimmed("fpds_status").alias("doge_status"),
        _trimmed("fpds_link").alias("source_url"),
    )


def grant_claims(pages: DataFrame) -> DataFrame:
    """Grant items in scope, on the claim columns; grants report no status."""
    items = pages.select(F.explode("result.grants").alias("item"))
    return items.where(P.names_agency("item.agency")).select(
        F.lit("grant").alias("claim_type"),
        S.url_path_id("item.link").alias("doge_award_id"),
        _trimmed("recipient").alias("recipient"),
        S.money("item.value").alias("doge_value"),
        S.money("item.savings").alias("doge_savings"),
        S.claim_date("item.date").alias("doge_claim_date"),
        F.lit("").alias("doge_status"),
        _trimmed("link").alias("source_url"),
    )


def claims_scan(contract_pages: DataFrame, grant_pages: DataFrame) -> DataFrame:
    """Every claim in scope of both kinds."""
    return contract_claims(contract_pages).unionByName(grant_claims(grant_pages))
