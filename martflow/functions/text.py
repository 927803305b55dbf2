"""Text formats the checks look for, and their repairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ends at the very end: a dollar sign would also allow a final line break.
POSTAL_CODE = r"\A[0-9]{5}\z"
NOT_BLANK = "\\S"


def repaired_postal_code(code: Column) -> Column:
    """Give numeric codes that lost leading zeros their five digits back."""
    return F.when(code.rlike(r"\A[0-9]{1,4}\z"), F.lpad(code, 5, "0")).otherwise(code)
