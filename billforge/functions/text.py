"""Text folding: what the same text written differently has in common. JVM expressions, but for Unicode forms."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

BLANKS = r"[\s\u0085\u00a0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
_BEYOND = r"[^\x00-\x7f]"
_UNEVEN = r"  |[\t-\r]|[^\x00-\x7f]"
_BLANK_SIGNS = "".join(c for c in map(chr, [*range(0x110), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF]) if re.fullmatch(BLANKS, c))
#: Separators used while several fields travel in one string: field of a struct, entry of an array, column.
FIELD, ENTRY, COLUMN = "\x1f", "\x1e", "\x1d"


@F.pandas_udf(StringType())
def _compose(text: pd.Series) -> pd.Series:
    """Compatibility composition and full case folding; only text beyond ASCII gets here, the rest arrives as null."""
    return text.map(lambda x: x if x is None else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", x).casefold()))


def strip(text: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.btrim(text, F.lit(_BLANK_SIGNS))


def fold(text: Column) -> Column:
    """Same letter case, Unicode form and blanks. Python sees only rows that hold a character beyond ASCII (and not just other blanks)."""
    blanks = F.regexp_replace(text, f"{BLANKS}+", " ")
    return _tidied(F.coalesce(_compose(F.when(blanks.rlike(_BEYOND), blanks)), F.lower(blanks)))


def _tidied(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, " {2,}", " "), " *([\x1d-\x1f]) *", "$1")


def with_folded(rows: DataFrame, text: Column, name: str) -> DataFrame:
    """rows with fold(text), in stages so that the blanks are looked for once."""
    rows = rows.withColumn("_blanks", F.when(text.rlike(_UNEVEN), F.regexp_replace(text, f"{BLANKS}+", " ")).otherwise(text))
    rows = rows.withColumn("_beyond", F.when(F.col("_blanks").rlike(_BEYOND), F.col("_blanks")))
    rows = rows.withColumn("_one", F.coalesce(_compose("_beyond"), F.lower("_blanks")))
    return rows.withColumn(name, _tidied(F.col("_one"))).drop("_blanks", "_beyond", "_one")


def entry(*fields: Column) -> Column:
    return F.concat_ws(FIELD, *(F.coalesce(x, F.lit("")) for x in fields))


def packed(*columns: Column) -> Column:
    """Columns (text, or arrays of text or of entry()) in one string, so that fold() runs once a row."""
    return F.concat_ws(COLUMN, *(F.coalesce(x, F.lit("")) for x in columns))


def entries(array: Column) -> Column:
    return F.concat_ws(ENTRY, array)


def same_set(folded: Column) -> Column:
    """Folded entries() as a set: sorted, each once, those without content left out."""
    parts = F.filter(F.transform(F.split(folded, ENTRY), lambda x: F.trim(x)), lambda x: F.regexp_replace(x, f"[{FIELD} ]", "") != "")
    return F.array_join(F.array_sort(F.array_distinct(parts)), ENTRY)


def part(folded: Column, index: int) -> Column:
    return F.trim(F.split(folded, COLUMN)[index])


def id_key(text: Column) -> Column:
    """An id as compared: without outer blanks and letter case."""
    return F.lower(strip(text))


def bill_key(identifier: Column) -> Column:
    """A bill identifier as its letters and its number: ``  h.b. 0012`` is ``HB 12``. Null or without content gives an empty string."""
    wide = F.upper(F.coalesce(identifier, F.lit("")))
    letters = F.regexp_replace(wide, r"[^\p{L}]+", "")
    digits = F.regexp_extract(wide, "[0-9]+", 0)
    number = F.when(digits == "", "").otherwise(F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.lit("0")))
    return F.trim(F.concat_ws(" ", letters, number))
