"""Column expressions on texts shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE_SPACE = " \t\n\x0b\x0c\r"
#: A table of sources or hosts may be broadcast up to these rows and bytes of names.
SMALL_ROWS, SMALL_BYTES = 100_000, 16 << 20


def whole(text: str) -> Column:
    """The text; empty where it is null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    """Sum of an array of longs, 0 if it is empty."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def small(table: DataFrame) -> DataFrame:
    """A pinned table, to be broadcast if it has few rows and short names; else it is joined by
    a shuffle, in which adaptive execution splits a hot key."""
    names = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, t in table.dtypes if t in ("string", "binary")]
    size = table.agg(
        F.count(F.lit(1)).alias("n"), F.sum(sum(names, F.lit(0).cast("long"))).alias("b")
    ).first()
    return F.broadcast(table) if size["n"] <= SMALL_ROWS and (size["b"] or 0) <= SMALL_BYTES else table


def row_key(docs: DataFrame, doc_id: str, text: str) -> tuple[Column, bool]:
    """The id, and true, if it names one row; else the id with the text, and false.

    Rows with equal keys are then the same document written down again.
    """
    clash = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n")).filter(
        (F.col("n") > 1) | F.col(doc_id).isNull()
    )
    if clash.isEmpty():
        return F.col(doc_id), True
    return F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"),
        F.sha2(F.coalesce(F.col(text).cast("binary"), F.lit(b"")), 256),
    ), False
