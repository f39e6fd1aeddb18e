"""Valid rows in the typed shape of the staging table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.functions.ids import digest
from rowgate.functions.text import quoted_name, with_normalised


def _fits(name: str, kind: str) -> str:
    text = quoted_name(name)
    fits = f"{text} is null or try_cast({text} as {kind}) is not null"
    if kind.startswith("decimal"):
        precision, scale = map(int, kind[len("decimal(") : -1].split(","))
        # Short digits always fit; converting to a wide decimal is the slow part.
        fits = f"length({text}) <= {precision - scale} or {fits}"
    return f"({fits})"


def fits_types(columns: Sequence[tuple[str, str, bool]]) -> Column:
    """Whether every present text converts to its column's type.

    Validation accepts numbers of any length; a table column does not. Such a
    value must fail its import, never turn into a null. For valid rows of
    normalised text.
    """
    tests = [_fits(name, kind) for name, kind, _ in columns if kind != "string"]
    return F.expr(" and ".join(tests))


def staging_rows(
    valid: DataFrame,
    columns: Sequence[tuple[str, str, bool]],
    identity: Sequence[str],
    as_of: Column,
    import_id: str = "import_id",
    row_number: str = "source_row_number",
) -> DataFrame:
    """Typed columns plus record id and provenance; blanks become nulls."""
    names = [name for name, _, _ in columns]
    return with_normalised(valid, names).select(
        digest("\n", *(F.col(name) for name in identity)).alias("record_id"),
        *(
            F.expr(f"try_cast({quoted_name(name)} as {kind})").alias(name)
            for name, kind, _ in columns
        ),
        F.col(import_id).alias("source_import_id"),
        F.col(row_number).cast("bigint").alias("source_row_number"),
        as_of.alias("ingested_at"),
    )
