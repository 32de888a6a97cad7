"""Lenient typing of string columns: anything unparseable becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.model import EntitySpec

ISO_DATE = "yyyy-MM-dd"


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def lenient_date(column: Column) -> Column:
    """Strict ISO date; a plain cast would also accept years, single digits and date-times."""
    return F.when(column.rlike(r"^\d{4}-\d{2}-\d{2}$"), column.try_cast("date"))


def lenient_decimal(column: Column, precision: int, scale: int) -> Column:
    return column.try_cast(f"decimal({precision},{scale})")


def lenient_instant(column: Column) -> Column:
    return column.try_cast("timestamp_ntz")


_PARSERS = {
    "text": blank_to_null,
    "date": lenient_date,
    "money": lambda column: lenient_decimal(column, 12, 2),
    "odd": lambda column: lenient_decimal(column, 8, 2),
    "instant": lenient_instant,
}

RECORD = "registro"


def type_rows(raw: DataFrame, spec: EntitySpec, *kept: str) -> DataFrame:
    """Typed business columns plus provenance, the untouched record as a struct and columns `kept`.

    The struct keeps only the strings: the object form is built from it later, for rejected rows
    alone. Consumers that do not read it let column pruning drop it.
    """
    typed = [_PARSERS[field.kind](F.col(field.name)).alias(field.name) for field in spec.fields]
    return raw.select(
        *typed,
        "arquivo_origem",
        "linha_origem",
        "lote_data",
        F.struct(*spec.columns).alias(RECORD),
        *kept,
    )


# One text of many: the gap between them, and the escape sign with its three letters.
_GAP, _SIGN = "\u0000", "\u0001"


def pack(columns: list[str]) -> Column:
    """Texts as one, which takes less room in a shuffle than a column each."""

    def shown(name: str) -> Column:
        signs = F.replace(F.col(name), F.lit(_SIGN), F.lit(f"{_SIGN}s"))
        return F.coalesce(F.replace(signs, F.lit(_GAP), F.lit(f"{_SIGN}g")), F.lit(f"{_SIGN}n"))

    return F.concat_ws(_GAP, *map(shown, columns))


def unpack(rows: DataFrame, packed: str, columns: list[str]) -> DataFrame:
    """The texts of `pack` as columns again, missing ones as NULL."""
    parts = rows.withColumn(packed, F.split(packed, _GAP))

    def read(at: int) -> Column:
        gaps = F.replace(F.get(packed, F.lit(at)), F.lit(f"{_SIGN}g"), F.lit(_GAP))
        text = F.nullif(gaps, F.lit(f"{_SIGN}n"))
        return F.replace(text, F.lit(f"{_SIGN}s"), F.lit(_SIGN))

    return parts.withColumns({name: read(at) for at, name in enumerate(columns)}).drop(packed)


def record_json(record: Column | str) -> Column:
    """The record as a JSON object text without its NULL fields."""
    return F.to_json(record)


def record_variant(record: Column | str) -> Column:
    return F.parse_json(record_json(record))
