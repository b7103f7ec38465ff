"""String cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: accented letters and their plain forms (for the optional
# accent-folding city rule).
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
PLAIN = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"


def clean_city(c: Column, fold_accents: bool = False) -> Column:
    """Title-case, then keep ASCII letters and white space only.

    By default accented letters are removed with the other characters
    (``São`` -> ``So``), which is the source behaviour; ``fold_accents``
    maps them to plain letters first.
    """
    c = F.trim(c)
    if fold_accents:
        c = F.translate(c, ACCENTED, PLAIN)
    return F.regexp_replace(F.initcap(c), r"[^a-zA-Z\s]", "")


def clean_state(c: Column) -> Column:
    """First two characters of the trimmed state code (case kept)."""
    return F.substring(F.trim(c), 1, 2)
