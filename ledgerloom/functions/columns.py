"""Column references that tolerate blanks, dots and stars in names."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def blank_to_null(c: Column) -> Column:
    """Null for text that is empty or only whitespace."""
    return F.when(~c.cast("string").rlike(r"^\s*$"), c)
