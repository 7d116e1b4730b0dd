"""PRJ-2 / TBL-6: payload fields that the declared schema doesn't know.

A source table gets a column, and its messages a field. The fixed schema drops
it. Here the fields that messages really have are read as variants, with the
type that fits all values of each, and added to the rows: the table's own
schema reconcile then takes them up. No code changes when a field comes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.schemas import ENVELOPE_SCHEMA

KNOWN = tuple(ENVELOPE_SCHEMA["payload"].dataType.fieldNames())
# Types that a column can be added as; anything else comes as its JSON text.
SCALARS = ("BIGINT", "BOOLEAN", "DATE", "DOUBLE", "FLOAT", "STRING", "TIMESTAMP")


def _payload(text: str) -> Column:
    return F.try_variant_get(F.try_parse_json(text), "$.payload", "variant")


def unknown_fields(parsed: DataFrame, text: str = "json_str", known: Sequence[str] = KNOWN) -> DataFrame:
    """(field, type): payload fields beyond the known ones, with a type that holds all their values.

    Numbers are BIGINT or DOUBLE, nested values their JSON text. For a column
    that a table has already, pass the table's type to ``with_unknown``.

    ``parsed`` has the message text. Messages that aren't JSON have no fields. A
    task merges its messages' types before the shuffle. Fields of nulls only
    have no type yet and are left out until they have; so are names with both
    kinds of quotes, which no variant path can hold.
    """
    fields = parsed.select(_payload(text).alias("p")).filter("p is not null and schema_of_variant(p) like 'OBJECT%'").lateralJoin(
        parsed.sparkSession.tvf.variant_explode(F.col("p").outer()))
    found = fields.filter(~F.col("key").isin(list(known)) & ~(F.col("key").contains("'") & F.col("key").contains('"'))).groupBy(F.col("key").alias("field")).agg(F.schema_of_variant_agg("value").alias("type"))
    # Decimals would change their type with every longer number.
    kind = (F.when(F.col("type").startswith("DECIMAL"), F.lit("DOUBLE")).when(F.col("type").isin(*SCALARS), F.col("type")).otherwise(F.lit("STRING")))
    return found.filter(F.col("type") != "VOID").select("field", kind.alias("type"))


def with_unknown(parsed: DataFrame, fields: Sequence[tuple[str, str]], text: str = "json_str") -> DataFrame:
    """``parsed`` with a column for each (field, type); null where a message lacks the field or holds another type."""
    def path(field: str) -> str:
        mark = "'" if '"' in field else '"'
        return f"$[{mark}{field}{mark}]"

    return parsed.withColumns({f: F.try_variant_get(_payload(text), path(f), t.lower()) for f, t in fields})
