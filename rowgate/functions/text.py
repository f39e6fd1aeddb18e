"""Text normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters ECMAScript treats as white space or line ends.
ECMA_WHITESPACE = (
    "\t\n\u000b\f\r\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# The characters a CSV tokenizer trims around a field.
CSV_WHITESPACE = " \t\n\f\r"


# Text of which only spaces can be trimmed.
_PRINTABLE_ASCII = r"\A[ -~]*\z"


def ecma_trim(value: Column) -> Column:
    """Trim the full ECMAScript white-space set; Spark's own trim stops at U+0020."""
    return F.trim(value, F.lit(ECMA_WHITESPACE))


def blank_to_null(value: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(ecma_trim(value), F.lit(""))


def quoted_name(name: str) -> str:
    """A column name for use inside expression text."""
    return "`" + name.replace("`", "``") + "`"


def quoted_text(text: str) -> str:
    """A string literal for use inside expression text."""
    return "'" + "".join(f"\\u{ord(c):04x}" if c in _ESCAPED else c for c in text) + "'"


_ESCAPED = ECMA_WHITESPACE.replace(" ", "") + "'\\"


def with_normalised(
    df: DataFrame, names: Sequence[str], target: str = "{}"
) -> DataFrame:
    """Every named text column through ``blank_to_null``, stored as ``target``.

    One look at the whole row decides how to trim it: trimming by character set
    costs several times a plain trim, and hardly any row needs it.
    """
    keep = df.columns
    plain = F.concat_ws("", *names).rlike(_PRINTABLE_ASCII)
    white = quoted_text(ECMA_WHITESPACE)
    trimmed = {
        target.format(name): F.expr(
            f"nullif(case when _plain then trim({quoted_name(name)}) "
            f"else trim(both {white} from {quoted_name(name)}) end, '')"
        )
        for name in names
    }
    added = [name for name in trimmed if name not in keep]
    return df.withColumn("_plain", plain).withColumns(trimmed).select(*keep, *added)


def has_suffix(value: Column, suffix: str) -> Column:
    """Case-insensitive suffix test."""
    return F.lower(value).endswith(suffix.lower())
