"""Text cleaning that keeps paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.schemas import JOURNAL_HEADER_PATTERN

# The characters that count as white space at either end, and the runs that are squeezed.
EDGE_WHITESPACE = " \t\n\x0b\f\r"
HORIZONTAL_RUN, ONE_SPACE = r"[ \t]+", " "
LINE_BREAK_RUN, PARAGRAPH_BREAK = r"\n{3,}", "\n\n"


def trim_whitespace(column: Column | str) -> Column:
    """Strip all white space at both ends, in one pass over the text."""
    return F.btrim(column, F.lit(EDGE_WHITESPACE))


def clean_body(column: Column | str) -> Column:
    """Drop the journal header and squeeze white space.

    Horizontal runs become one space and three or more line breaks become two,
    so paragraph breaks stay.  The ends are trimmed without a pattern, which
    would try every run of white space inside the text as well.
    """
    body = F.regexp_replace(column, JOURNAL_HEADER_PATTERN, "")
    body = F.regexp_replace(body, HORIZONTAL_RUN, ONE_SPACE)
    body = F.regexp_replace(body, LINE_BREAK_RUN, PARAGRAPH_BREAK)
    return trim_whitespace(body)


def with_clean_text(df: DataFrame) -> DataFrame:
    """Clean ``text`` and trim ``title``."""
    return df.withColumns({"text": clean_body("text"), "title": trim_whitespace("title")})
