"""Text and number expressions: stripping, squashing, coercion, messages.  All are Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Confidence of decisions taken from geometry and from inheritance, and the review threshold.
GEOMETRIC_CONFIDENCE, DITTO_CONFIDENCE, REVIEW_BELOW = 0.97, 0.75, 0.60
#: A page with a text layer of at least so many characters needs no recognition.
TEXT_LAYER_CHARS = 40
HEADER_BAND = 0.18


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squash(c: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def normalize(c: Column) -> Column:
    """Single spaces, none at the ends, lower case."""
    return F.lower(strip(F.regexp_replace(c, r"(?U)\s+", " ")))


def coerce_number(c: Column) -> Column:
    """``struct(value decimal(38,0), clean)``: the ASCII digits of a text as one number.

    Lossy on purpose: 4.5 gives 45 and -5 gives 5, both not clean; no digits give null.
    ``clean`` says that the stripped text was digits only.
    """
    text = strip(c)
    digits = F.regexp_replace(text, "[^0-9]", "")
    value = F.when(digits != "", digits).try_cast("decimal(38,0)")
    return F.struct(value.alias("value"), F.coalesce(value.isNotNull() & (digits == text), F.lit(False)).alias("clean"))


def coerce_text(c: Column) -> Column:
    """``struct(value, clean)``: the stripped text, null and not clean if nothing is left."""
    text = strip(c)
    return F.struct(F.nullif(text, F.lit("")).alias("value"), F.coalesce(text != "", F.lit(False)).alias("clean"))


def is_ditto(c: Column, markers: list[str]) -> Column:
    """Whether a text, squashed, is one of the marks that repeat the row above."""
    return F.coalesce(squash(c).isin(*markers), F.lit(False)) if markers else F.lit(False)


def penalized(confidence: Column, clean: Column) -> Column:
    """Half the confidence for a value that fought its type."""
    return confidence * F.when(clean, 1.0).otherwise(0.5)


def header_band(text: Column, share: float = HEADER_BAND) -> Column:
    return F.substring(text, F.lit(1), F.greatest(F.lit(1), F.floor(F.length(text) * share).cast("int")))


def page_source(text: Column, least: int = TEXT_LAYER_CHARS) -> Column:
    """``text`` for a page whose text layer is long enough, else ``scan``."""
    return F.when(F.length(strip(text)) >= least, "text").otherwise("scan")


def check_message(target: str, total: Column, parts: list[str], got: Column) -> Column:
    return F.concat(F.lit(f"{target}="), total.cast("string"), F.lit(f" but sum({'+'.join(parts)})="), got.cast("string"))


def page_stem(file: Column, page: Column) -> Column:
    """The file's name without suffix, and the page, spaces as underscores."""
    return F.replace(F.concat(F.regexp_replace(file, r"\.[^.]*$", ""), F.lit("_p"), page.cast("string")), F.lit(" "), F.lit("_"))


def engine_flags(numeric: Column, mode: int = 7) -> Column:
    """Flags for an external recognizer; numeric cells are restricted to digits."""
    return F.concat_ws(" ", F.lit(f"--psm {mode}"), F.lit("--oem 3"), F.when(numeric, "-c tessedit_char_whitelist=0123456789"))
