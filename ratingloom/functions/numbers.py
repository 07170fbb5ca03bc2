"""Text to number without exceptions: null where the text is not a number.

A pattern guards each cast: the casts alone would take '5d' or 'NaN' for a rating, and pay for an
internal exception per bad text. Pattern and cast both pass over surrounding white space.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number formats accepted in uploads, forms and requests.
WHITESPACE = " \t\r\n\f\v"
INTEGER_PATTERN = r"^[ \t\r\n\f\x0B]*[+-]?[0-9]+[ \t\r\n\f\x0B]*$"
NUMBER_PATTERN = (
    r"^[ \t\r\n\f\x0B]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n\f\x0B]*$"
)


def strip(text: Column) -> Column:
    """Cut white space of every kind from both ends (``trim`` only cuts blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def to_id(text: Column, width: str = "bigint") -> Column:
    """A whole number, as bigint; null also where it does not fit ``width``."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(width).cast("bigint"))


def to_number(text: Column) -> Column:
    """A double; a number too large for one comes out infinite."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
