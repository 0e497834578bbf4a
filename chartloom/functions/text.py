"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -----------------------------------------------------------------
# Marks that may surround the digits of an amount.
AMOUNT_MARKS = "$,₹"
# Every character that counts as white space at the end of a text value.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ------------------------------------------------------------------------------


def column(name: str) -> Column:
    """Reference a column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim_text(text: Column) -> Column:
    """Remove white space of any kind at both ends.

    ``trim`` with a character list is linear in the ends it removes; a regular
    expression anchored at the end would restart at every inner run of blanks.
    """
    return F.trim(text, F.lit(WHITE_SPACE))


def drop_marks(text: Column) -> Column:
    """Remove currency signs and thousands separators."""
    return F.translate(text, AMOUNT_MARKS, "")
