"""What counts as a usable value of a field filled in by hand."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words written only to stand for absence or repetition
# (compared without case and without spaces or punctuation around them).
STAND_IN_WORDS = (
    "as above", "blank", "ditto", "do", "idem", "missing", "n a", "n/a", "na", "nil", "no entry",
    "none", "not available", "not known", "null", "same", "same as above", "tba", "tbc", "tbd",
    "unknown", "vendor", "x", "xx", "xxx", "xxxx",
)
# Quantities written only to stand for absence.
STAND_IN_QUANTITIES = (-1, 9999, 99999)


def usable_text(col: Column | str) -> Column:
    """True where a text is neither null, blank, only punctuation, nor a stand-in word.

    Anything without a letter or digit (ditto marks, dashes, dots) stands for
    absence or repetition, so it is not usable; null gives False, never null.
    """
    c = F.col(col) if isinstance(col, str) else col
    core = F.lower(F.regexp_replace(c, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.coalesce((F.length(core) > 0) & ~core.isin(*STAND_IN_WORDS), F.lit(False))


def usable_quantity(col: Column | str, stand_ins: tuple[int, ...] = STAND_IN_QUANTITIES) -> Column:
    """True where a quantity is a whole number of at least 1 and no stand-in.

    A quantity that merely looks too large stays usable.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce((c >= 1) & ~c.isin(*[int(x) for x in stand_ins]), F.lit(False))
