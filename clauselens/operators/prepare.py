"""Text preparation: documents to clauses, lines, paragraphs and headers.

All of it is row-local.  A document's clauses and lines live in arrays beside its
id, so extraction needs no shuffle; ``to_clauses``/``to_lines`` explode the same
arrays into long tables for callers who want rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauselens.functions import vocab as V
from clauselens.functions.text import clean_markdown, fold_ref, is_ascii, split_clauses, split_lines, split_paragraphs

ID = "contract_id"


def clean(contracts: DataFrame) -> DataFrame:
    """Replace ``text`` by its cleaned form."""
    return contracts.withColumn("text", clean_markdown(F.col("text")))


def with_lines(contracts: DataFrame) -> DataFrame:
    return contracts.withColumn("lines", split_lines(F.col("text")))


def clauses_of(text: Column, clause_chars: int | None = None) -> Column:
    """Array of (idx, clause, folded) in document order."""
    return F.transform(split_clauses(text, clause_chars), lambda c, i: F.struct(
        i.alias("idx"), c.alias("clause"), fold_ref(c).alias("folded")))


def with_clauses(contracts: DataFrame) -> DataFrame:
    return contracts.withColumn("clauses", clauses_of(F.col("text")))


def with_header(contracts: DataFrame, header_lines: int = V.HEADER_LINES) -> DataFrame:
    """Add ``header`` (the first lines, body included) and ``folded_header``; needs ``lines``."""
    top = F.slice("lines", 1, header_lines)
    headed = contracts.withColumn("header", F.array_join(top, "\n"))
    return headed.withColumn("folded_header", fold_ref(F.col("header")))


def prepare(contracts: DataFrame, header_lines: int = V.HEADER_LINES) -> DataFrame:
    """Everything the extraction rules look at, computed once per document."""
    return with_header(with_clauses(with_lines(contracts)), header_lines).withColumn("plain", is_ascii(F.col("text")))


# The long tables explode the array expression itself.  Exploding a computed column
# would let the optimizer infer a filter on it and evaluate the expression twice.

def to_clauses(contracts: DataFrame, clause_chars: int | None = None) -> DataFrame:
    """Long table (contract_id, clause_idx, clause, folded)."""
    rows = contracts.select(ID, F.explode(clauses_of(F.col("text"), clause_chars)).alias("c"))
    return rows.select(ID, F.col("c.idx").alias("clause_idx"), "c.clause", "c.folded")


def to_lines(contracts: DataFrame) -> DataFrame:
    """Long table (contract_id, line_idx, line, folded)."""
    lines = contracts.select(ID, F.posexplode(split_lines(F.col("text"))).alias("line_idx", "line"))
    return lines.withColumn("folded", fold_ref(F.col("line")))


def to_paragraphs(contracts: DataFrame, min_chars: int = V.PARAGRAPH_MIN_CHARS) -> DataFrame:
    """Long table (contract_id, para_idx, paragraph)."""
    paragraphs = split_paragraphs(F.col("text"), min_chars)
    return contracts.select(ID, F.posexplode(paragraphs).alias("para_idx", "paragraph"))
