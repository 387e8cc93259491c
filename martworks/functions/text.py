"""Text, JSON and number repair."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

AGREEMENT_SEPARATOR = ":+"


def decimal_comma(c: Column) -> Column:
    """'-33,865' -> -33.865; text that is no number becomes null."""
    return F.translate(c.cast("string"), ",", ".").try_cast("double")


def split_part(c: Column, pattern: str, index: int, cast: str = "string") -> Column:
    """1-based part of a regex split, cast; null when there are fewer parts."""
    return F.try_element_at(F.split(c, pattern), F.lit(index)).cast(cast)


def json_field(c: Column, path: str, cast: str = "string") -> Column:
    """One field of a JSON text, e.g. json_field(c, 'order_id', 'bigint')."""
    return F.get_json_object(c, f"$.{path}").try_cast(cast)


def parse_json(c: Column, schema: T.StructType | str) -> Column:
    """A whole JSON document; malformed text gives null."""
    return F.from_json(c, schema)


def canonical_json(fields: dict[str, Column]) -> Column:
    """JSON with sorted keys, kept nulls and second-precision timestamps."""
    ordered = [fields[name].alias(name) for name in sorted(fields)]
    return F.to_json(
        F.struct(*ordered),
        {"timestampFormat": "yyyy-MM-dd HH:mm:ss",
         "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
         "ignoreNullFields": "false"},
    )


def json_message(*columns: Column | str) -> Column:
    """The JSON text of a struct of the given columns."""
    return F.to_json(F.struct(*columns))


def kafka_text(df):
    """Key and value of a topic as strings."""
    return df.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})
