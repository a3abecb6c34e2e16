"""Schema drift: what the payloads of bronze hold, compared with what the readers expect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestream.functions.payload import with_json
from lakestream.schemas import READING_V1

#: Families of variant types; a number with decimals is a DECIMAL or a DOUBLE, whatever its digits.
FAMILIES = {"STRING": "text", "BOOLEAN": "boolean", "BIGINT": "integer", "DOUBLE": "number", "VOID": "null"}
#: What a reader of each kind takes.
TAKEN = {
    "string": ("text", "null"),
    "double": ("number", "integer", "null"),
    "bigint": ("integer", "null"),
    "boolean": ("boolean", "null"),
}


def family_of(value: Column) -> Column:
    """The family of a variant's type."""
    kind = F.schema_of_variant(value)
    found = F.when(kind.startswith("DECIMAL"), "number").when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "list")
    for name, family in FAMILIES.items():
        found = found.when(kind == name, family)
    return found.otherwise(F.lower(kind))


def payload_fields(payloads: DataFrame, by: Sequence[str], text: str = "raw_json") -> DataFrame:
    """Per group, field and family of its values: how many payloads hold it, and of how many objects in all. Payloads
    that are not exactly one JSON object are left out.

    The objects of a group are counted in the same pass, as the field without a name.
    """
    parsed = with_json(payloads.select(*by, F.col(text).alias("_text")), F.col("_text"), "_doc")
    objects = parsed.filter(F.schema_of_variant("_doc").startswith("OBJECT"))
    fields = F.from_json(F.to_json("_doc"), "map<string,variant>")
    pairs = F.transform(F.map_entries(fields), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("value")))
    itself = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.col("_doc").alias("value")))
    each = objects.select(*by, F.inline(F.concat(pairs, itself)))
    counted = each.select(*by, "field", family_of(F.col("value")).alias("found")).groupBy(*by, "field", "found").agg(
        F.count(F.lit(1)).alias("payloads")
    )
    whole = counted.filter(F.col("field").isNull()).select(*by, F.col("payloads").alias("objects"))
    return counted.filter(F.col("field").isNotNull()).join(whole, list(by))


def schema_drift(payloads: DataFrame, by: Sequence[str], schema: StructType = READING_V1, text: str = "raw_json") -> DataFrame:
    """What the payloads of each group have that the schema does not: fields `added`, fields `retyped` (values of a
    family that the reader does not take), and fields `missing` from some of the objects. A row per field and kind
    of drift: `field`, `drift`, `found` (the family; null where missing), `payloads`."""
    fields = payload_fields(payloads, by, text)
    expected = {f.name: f.dataType.simpleString() for f in schema.fields}
    known = F.col("field").isin(*expected)
    taken = F.lit(False)
    for name, kind in expected.items():
        taken = taken | ((F.col("field") == name) & F.col("found").isin(*TAKEN.get(kind, ())))
    drift = F.when(~known, "added").when(~taken, "retyped")
    there = fields.withColumn("drift", drift).filter("drift IS NOT NULL").select(*by, "field", "drift", "found", "payloads")
    held = fields.groupBy(*by).pivot("field", list(expected)).agg(F.sum("payloads"))
    totals = fields.groupBy(*by).agg(F.max("objects").alias("_objects"))
    lacking = held.join(totals, list(by)).select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("field"), (F.col("_objects") - F.coalesce(F.col(f"`{name}`"), F.lit(0))).alias("payloads")
                    )
                    for name in expected
                ]
            )
        ),
    )
    lacking = lacking.filter("payloads > 0").select(
        *by, "field", F.lit("missing").alias("drift"), F.lit(None).cast("string").alias("found"), "payloads"
    )
    return there.unionByName(lacking)
