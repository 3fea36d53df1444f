"""Text cleaning with the Unicode rules Python users expect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts a CSV reader in the Python world takes for a missing value.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_SPACE = r"[\s\x1c-\x1f]"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends; the built-in trim only knows the blank."""
    return F.regexp_replace(c, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def title(c: Column) -> Column:
    """Capital after every character without case.

    ``initcap`` starts words at blanks only, so it is applied to each run of cased letters:
    "d'oeste" becomes "D'Oeste" and "2nd" becomes "2Nd".
    """
    runs = F.regexp_extract_all(F.lower(c), F.lit(rf"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def clean_upper(c: Column) -> Column:
    return F.upper(strip(c))


def clean_title(c: Column) -> Column:
    return title(strip(c))


def na_to_null(c: Column) -> Column:
    return F.when(c.isin(*NA_TEXTS), F.lit(None)).otherwise(c)
