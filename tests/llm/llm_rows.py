"""Rows that every operator has to bear, and how tests read results."""

from pyspark.sql import DataFrame, SparkSession

LONG = "wander along the quiet river until evening falls again " * 4000

#: Null ids and texts, empty and blank texts, one word, repeated rows, a very long text.
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta"),
    (1, "alpha beta gamma delta epsilon zeta eta theta"),
    (2, None),
    (3, ""),
    (4, " \n\t \n"),
    (None, "a text without an id and a few more words"),
    (None, None),
    (5, "word"),
    (6, LONG),
    (7, "naïve façade   日本語 <|endoftext|> \x1c  end\r\n"),
]


def documents(spark: SparkSession, rows, extra: bool = False) -> DataFrame:
    """A table of documents; `extra` adds columns whose names operators use themselves."""
    df = spark.createDataFrame(list(rows), "doc_id long, text string")
    if not extra:
        return df
    names = "row kept score part place line first covered node label before key_a value n_chars"
    return df.selectExpr("*", *[f"'x' AS {name}" for name in names.split()])


def table(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
