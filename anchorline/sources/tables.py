"""Published tables: typed CSV in and out, with Parquet as the primary sink."""

from __future__ import annotations

import hashlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorline.functions import scalars as S
from anchorline.operators.guards import IncompleteInputError


def render(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Every cell as the text it is published as.

    ISO dates, true/false, plain decimals, blanks for nulls, one line per cell.
    """
    cells = []
    for field in schema.fields:
        text = F.col(field.name).cast("string")
        if isinstance(field.dataType, T.StringType):
            text = S.collapse_ws(field.name)
        cells.append(S.blank(text).alias(field.name))
    return df.select(*cells)


def parse(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rendered text back to declared types: blank text stays blank, other blanks are null."""
    cells = []
    for field in schema.fields:
        text = S.blank(field.name)
        if isinstance(field.dataType, T.StringType):
            cell = text
        elif isinstance(field.dataType, T.BooleanType):
            cell = F.when(text != "", text == "true")
        else:
            cell = F.nullif(text, F.lit("")).cast(field.dataType)
        cells.append(cell.alias(field.name))
    return df.select(*cells)


def write_csv(df: DataFrame, path: str, schema: T.StructType, *, empty: bool | None = None) -> None:
    """Write a published table as a folder of CSV parts that keep the frame's row order.

    A frame with no rows is written without a header, so it reads back as no rows. A caller
    that knows whether it is empty saves the look.
    """
    rendered = render(df, schema)
    (
        rendered.write
        .option("header", not (rendered.isEmpty() if empty is None else empty))
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.text(path).inputFiles())
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a published table by the names in its header.

    Columns may come in any order, and others may stand beside them; a declared column that
    is missing is an error, and so is a part whose header differs from the others'. A missing
    or empty table has no rows.
    """
    if not path_exists(spark, os.fspath(path)):
        return spark.createDataFrame([], schema)
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", False)
        .csv(path)
    )
    if not raw.columns:
        return spark.createDataFrame([], schema)
    missing = [name for name in schema.names if name not in raw.columns]
    if missing:
        raise IncompleteInputError(f"{path} has no column {', '.join(missing)}")
    return parse(raw, schema)


#: Files that a table kept by key is dealt into.
BUCKETS = 64


def _table_name(path: str) -> str:
    """The catalog's name for a folder."""
    return "anchorline_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(df: DataFrame, path: str, key: str, *, buckets: int = BUCKETS) -> None:
    """A table kept by key: one file per bucket, so that a later grouping or join by the key
    moves none of its rows. No key should hold many rows."""
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(_table_name(path))
    )


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, key: str, *, buckets: int = BUCKETS
) -> DataFrame:
    """A table that `write_bucketed` wrote, in this or another session.

    Buckets are the catalog's knowledge; a session that has not seen the folder is told.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    name = _table_name(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
