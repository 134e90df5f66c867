"""CELEX identifiers: sector digit, four-digit year, document-type letter."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.schemas import DOC_TYPE_LABELS, OTHER_LABEL, SECTOR_LABELS


# Where an identifier holds its sector, year and document type.
SECTOR_PATTERN = r"^(\d)"
YEAR_PATTERN = r"^\d(\d{4})"
TYPE_PATTERN = r"^\d{5}([A-Z])"


def _leading(celex_id: Column | str, pattern: str) -> Column:
    # regexp_extract answers "" for no match; NULL is what a reader of the
    # partitioned layer gets back, so the two sides agree from the start.
    return F.nullif(F.regexp_extract(celex_id, pattern, 1), F.lit(""))


def celex_sector(celex_id: Column | str) -> Column:
    return _leading(celex_id, SECTOR_PATTERN)


def celex_year(celex_id: Column | str) -> Column:
    # try_cast: under ANSI rules a plain cast of a malformed id would fail the job.
    return _leading(celex_id, YEAR_PATTERN).try_cast("int")


def celex_doc_type(celex_id: Column | str) -> Column:
    return _leading(celex_id, TYPE_PATTERN)


def label_for(code: Column | str, labels: dict[str, str], default: str | None = None) -> Column:
    """Look a code up in a fixed label table kept as a literal map."""
    code = F.col(code) if isinstance(code, str) else code
    label = F.create_map(*[F.lit(v) for v in chain.from_iterable(labels.items())])[code]
    return label if default is None else F.coalesce(label, F.lit(default))


def with_celex_components(df: DataFrame) -> DataFrame:
    """Add ``sector``, ``year`` and ``doc_type``; NULL where the id is malformed."""
    return df.withColumns(
        {"sector": celex_sector("celex_id"), "year": celex_year("celex_id"), "doc_type": celex_doc_type("celex_id")}
    )


def with_doc_type_label(df: DataFrame) -> DataFrame:
    """Add the readable document type, ``Other`` for letters without a label."""
    return df.withColumn("doc_type_label", label_for("doc_type", DOC_TYPE_LABELS, OTHER_LABEL))


def with_sector_label(df: DataFrame) -> DataFrame:
    """Add the readable sector; NULL for an unknown sector."""
    return df.withColumn("sector_label", label_for("sector", SECTOR_LABELS))
