"""Number expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: decimal text; a fraction is cut off, as a plain cast of text to an integer does.
DECIMAL_TEXT = r"^[\x00-\x20]*([+-]?[0-9]+)(?:\.[0-9]*)?[\x00-\x20]*$"


def whole_number(value: Column | str, kind: str) -> Column:
    """`value` as an integer type, null when it is no number or out of range.

    The layout test keeps text that cannot be a number away from the cast, where each failure
    costs an exception.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value.rlike(DECIMAL_TEXT), F.regexp_extract(value, DECIMAL_TEXT, 1).try_cast(kind))
