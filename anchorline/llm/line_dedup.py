"""Repeated passages removed by overlapping three-line windows, in DataFrame functions alone.

Every three consecutive lines of a document that are not blank are hashed. A window found
twice or more in the corpus keeps its first occurrence, by document id and line; the lines
that later occurrences cover are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import row_key, text_of
from anchorline.sources.staging import Staging

SIZE = 3
#: ASCII white space that does not end a line.
BLANKS = " \t\r\x0b\x0c"
KEY = ["doc_id", "key_a", "key_b"]


def once(column: Column) -> Column:
    """The column, worked out once per row. Plans put an expression in the place of its name
    also inside the functions of arrays, where it would be worked out for every element."""
    return F.explode(F.array(column))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def full_lines(text: Column) -> Column:
    """Places and texts of the lines that are not blank."""
    placed = F.transform(
        lines_of(text), lambda x, i: F.struct(i.alias("place"), F.trim(x, F.lit(BLANKS)).alias("line"))
    )
    return F.filter(placed, lambda x: x["line"] != "")


def windows(docs: DataFrame) -> DataFrame:
    """A row per window: its document, the number of its first full line, and two hashes."""

    def window(k: Column) -> Column:
        lines = [F.element_at("full", k + i)["line"] for i in range(1, SIZE + 1)]
        return F.struct(
            k.alias("at"),
            F.xxhash64(*lines).alias("hash_a"),
            F.xxhash64(F.lit(1), *lines).alias("hash_b"),
        )

    return (
        docs.select(*KEY, once(full_lines(F.col("text"))).alias("full"))
        .where(F.size("full") >= SIZE)
        .select(
            *KEY,
            F.explode(F.transform(F.sequence(F.lit(0), F.size("full") - SIZE), window)).alias("w"),
        )
        .select(*KEY, "w.*")
    )


def later_lines(docs: DataFrame, staging: Staging) -> DataFrame:
    """Per document the numbers of full lines that later occurrences cover.

    The first occurrences come from one aggregation that combines before it shuffles. Windows
    found once drop out there, so that the join back meets repeated windows only. Both sides
    of that join are stored tables, so that adaptive execution can split a window that a
    third of all rows share: it is one row on one side.
    """
    every = staging.table(windows(docs), "windows")
    first = (
        every.groupBy("hash_a", "hash_b")
        .agg(F.min(F.struct(*KEY, "at")).alias("first"), F.max(F.struct(*KEY, "at")).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .drop("last")
    )
    first = staging.table(first, "first")
    same = F.lit(True)
    for name in KEY:
        same = same & F.col(name).eqNullSafe(F.col(f"first.{name}"))
    later = every.join(first, ["hash_a", "hash_b"]).where(
        ~(same & (F.col("at") == F.col("first.at")))
    )
    # Where a passage repeats onto itself, the lines of its first occurrence stay.
    start = F.when(same, F.greatest("at", F.col("first.at") + SIZE)).otherwise(F.col("at"))
    return (
        later.select(*KEY, F.explode(F.sequence(start, F.col("at") + SIZE - 1)).alias("covered"))
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set("covered")).alias("covered"))
    )


def _merged(covered: Column) -> Column:
    """Sorted numbers as runs: struct(start, stop), stop after the last."""

    def apart(step: int):
        """Numbers whose neighbour on one side is not the next one."""
        return lambda n, i: ~F.get(covered, i + step).eqNullSafe(n + step)

    starts = F.filter(covered, lambda n, i: (i == 0) | apart(-1)(n, i))
    ends = F.filter(covered, apart(1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("stop")))


def _without(lines: Column, gone: Column) -> Column:
    """An array without the elements at the places of `gone`, which ascend: the slices between."""
    n = F.size(gone)

    def between(k: Column) -> Column:
        before = F.when(k == 0, F.lit(-1)).otherwise(F.get(gone, k - 1))
        after = F.when(k == n, F.size(lines)).otherwise(F.get(gone, k))
        return F.slice(lines, before + 2, after - before - 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), n), between))


def dedup_lines(docs: DataFrame, staging: Staging) -> DataFrame:
    """Per document its text without later occurrences: doc_id, text, n_lines, n_removed, removed.

    Lines are what line feeds separate, without white space at their ends; blank lines form no
    window and stay. `removed` holds the removed full lines as runs. Documents of fewer than
    three full lines stay as they are, so do null texts, as empty ones. Rows equal in id and
    text count as one document and keep the same text. Null ids stay null and come first. An
    empty table gives no row. Columns other than `doc_id` and `text` are not read.
    """
    return _dedup(docs.select("doc_id", "text"), staging).select(
        "doc_id", "text", "n_lines", "n_removed", "removed"
    )


def _dedup(docs: DataFrame, staging: Staging) -> DataFrame:
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        *row_key(text_of()),
        F.struct(*docs.columns).alias("row"),
    )
    later = later_lines(keyed, staging).withColumnsRenamed({k: f"later_{k}" for k in KEY})
    match = [F.col(k).eqNullSafe(F.col(f"later_{k}")) for k in KEY]
    covered = F.coalesce(F.col("covered"), F.array().cast("array<int>"))
    parts = F.struct(covered.alias("covered"), full_lines(F.col("text")).alias("full"))
    places = F.transform("p.covered", lambda n: F.element_at("p.full", n + 1)["place"])
    n_covered = F.size("p.covered")
    return (
        keyed.join(later, match, "left")
        .select("row", "doc_id", "text", once(parts).alias("p"))
        .select("row", "doc_id", "text", "p", once(F.struct(places.alias("gone"), F.when(
            n_covered > 0, lines_of(F.col("text"))
        ).alias("lines"))).alias("q"))
        .select(
            "row",
            "doc_id",
            F.when(n_covered == 0, F.col("text"))
            .otherwise(F.array_join(_without(F.col("q.lines"), F.col("q.gone")), "\n"))
            .alias("text"),
            F.size("p.full").cast("long").alias("n_lines"),
            n_covered.cast("long").alias("n_removed"),
            _merged(F.col("p.covered")).alias("removed"),
        )
    )


def without_repeats(docs: DataFrame, staging: Staging) -> DataFrame:
    """The documents with their texts so reduced, their n_chars, and all other columns.

    A document all of whose lines are removed goes.
    """
    # The condition must not name the new text: pushed down, it would make it for every line.
    left = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))
    reduced = _dedup(docs, staging).where(left)
    new = {"text": F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, size).otherwise(F.col("row.n_chars"))
    return reduced.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


_LINE = "trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12))"
#: The same result in DuckDB: doc_id, text, n_lines, n_removed.
SQL = f"""
WITH docs AS (
  SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS place,
         unnest(string_split(text, chr(10))) AS line
  FROM docs
), full_lines AS (
  SELECT doc_id, text, place, {_LINE} AS line,
         row_number() OVER (PARTITION BY doc_id, text ORDER BY place) - 1 AS num
  FROM split WHERE {_LINE} <> ''
), windows AS (
  SELECT doc_id, text, num, line AS a,
         lead(line, 1) OVER each_doc AS b, lead(line, 2) OVER each_doc AS c
  FROM full_lines WINDOW each_doc AS (PARTITION BY doc_id, text ORDER BY num)
), ranked AS (
  SELECT doc_id, text, num,
         first_value(doc_id) OVER same AS first_id, first_value(text) OVER same AS first_text,
         first_value(num) OVER same AS first_num
  FROM windows WHERE c IS NOT NULL
  WINDOW same AS (PARTITION BY a, b, c ORDER BY doc_id NULLS FIRST, text, num)
), covered AS (
  SELECT DISTINCT r.doc_id, r.text, r.num + k AS num
  FROM ranked r, range(3) AS t(k)
  WHERE NOT (r.doc_id IS NOT DISTINCT FROM first_id AND r.text = first_text AND r.num = first_num)
    AND NOT (r.doc_id IS NOT DISTINCT FROM first_id AND r.text = first_text
             AND r.num + k < first_num + 3)
), gone AS (
  SELECT f.doc_id, f.text, f.place
  FROM full_lines f JOIN covered c
    ON f.doc_id IS NOT DISTINCT FROM c.doc_id AND f.text = c.text AND f.num = c.num
), kept AS (
  SELECT s.doc_id, s.text, string_agg(s.line, chr(10) ORDER BY s.place) AS rest
  FROM split s LEFT JOIN gone g
    ON s.doc_id IS NOT DISTINCT FROM g.doc_id AND s.text = g.text AND s.place = g.place
  WHERE g.place IS NULL GROUP BY 1, 2
), counts AS (
  SELECT doc_id, text, count(*) AS n_lines FROM full_lines GROUP BY 1, 2
), removed AS (
  SELECT doc_id, text, count(*) AS n_removed FROM gone GROUP BY 1, 2
)
SELECT d.doc_id, coalesce(k.rest, '') AS text, coalesce(c.n_lines, 0) AS n_lines,
       coalesce(r.n_removed, 0) AS n_removed
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) d
LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.text = k.text
LEFT JOIN counts c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.text = c.text
LEFT JOIN removed r ON d.doc_id IS NOT DISTINCT FROM r.doc_id AND d.text = r.text
"""
