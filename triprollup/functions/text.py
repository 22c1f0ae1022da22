"""Column expressions that read one trip line.

The rules are those of a JVM ``split`` followed by JVM number parsing: trailing empty
fields vanish, an integer is 32 bits wide and takes no blanks, a floating number may
be ``NaN``, ``Infinity``, ``1e3`` or ``1d`` but not ``nan`` or ``inf``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_TEXT = r"^[+-]?[0-9]+\z"
# Texts that may rightly give no finite number: the two spelled-out literals, and
# digits too large for the type. A cast alone would also take "nan", "inf" and the like.
NON_FINITE_TEXT = "NaN|Infinity|[0-9]"


def split_fields(line: Column) -> Column:
    """Fields of a comma-separated line; trailing empty fields are dropped."""
    # Trimming costs as much as splitting, so only lines that need it pay for it.
    trimmed = F.when(line.endswith(","), F.rtrim(line, F.lit(","))).otherwise(line)
    return F.split(trimmed, ",")


def parse_int32(text: Column) -> Column:
    """A 32-bit integer widened to bigint; null where the text is none."""
    # The pattern is needed because a cast ignores blanks around the digits.
    return F.when(text.rlike(INT_TEXT), text.try_cast("int")).cast("bigint")


def is_misread(number: Column, text: Column) -> Column:
    """True where a floating cast failed, or took a literal the JVM parser refuses."""
    finite = F.abs(number) < F.lit(float("inf"))
    return number.isNull() | ~(finite | text.rlike(NON_FINITE_TEXT))
