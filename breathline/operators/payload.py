"""Messages as VARIANT: what a rejected one lacks, and which fields the feed sends.

The parser keeps the fields it knows. Here the whole message stays queryable, so a new field of the feed is found
without a new schema, and a row in quarantine says why it is there.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructType

from breathline.schema import ENVELOPE

# Numbers that JSON has no form for; the feed sends them as texts.
NOT_FINITE = ["NaN", "Infinity", "+Infinity", "-Infinity", "INF", "+INF", "-INF"]


def message(value: Column) -> Column:
    """The message as VARIANT; null where the text is not JSON or names a key twice."""
    return F.try_parse_json(value.cast("string"))


def kind(value: Column) -> Column:
    """object, array, text, flag, none (JSON's null) or number."""
    said = F.schema_of_variant(value)
    return (
        F.when(said.startswith("OBJECT"), "object").when(said.startswith("ARRAY"), "array").when(said == "STRING", "text")
        .when(said == "BOOLEAN", "flag").when(said == "VOID", "none").when(said.isNotNull(), "number")
    )


def _fields(of: StructType, path: str = "") -> Iterator[tuple[str, DataType]]:
    for field in of:
        yield path + field.name, field.dataType
        if isinstance(field.dataType, StructType):
            yield from _fields(field.dataType, f"{path}{field.name}.")


def _is_bad(whole: Column, path: str, wanted: DataType) -> Column:
    """Whether the field is there with a value that its type cannot take."""
    value = F.variant_get(whole, f"$.{path}", "variant")
    cast = F.try_variant_get(whole, f"$.{path}", wanted.simpleString())
    if isinstance(wanted, StringType):
        bad = F.lit(False)
    elif isinstance(wanted, StructType):
        bad = kind(value) != "object"
    elif isinstance(wanted, ArrayType):
        bad = (kind(value) != "array") | cast.isNull()
    elif isinstance(wanted, DoubleType):
        named = F.coalesce(F.try_variant_get(whole, f"$.{path}", "string").isin(*NOT_FINITE), F.lit(False))
        bad = (kind(value) != "number") & ~named
    else:
        bad = (F.schema_of_variant(value) != "BIGINT") | cast.isNull()
    return value.isNotNull() & (kind(value) != "none") & bad


def reasons(records: DataFrame) -> DataFrame:
    """The messages with ``city``, ``reason`` and ``bad_fields``.

    ``reason`` is the first that holds of: not_json (also an empty or missing value, and a key named twice), not_object,
    no_city, no_payload (missing, null or no object), bad_field; null for a message without fault. ``bad_fields`` names the
    fields whose value their type cannot take, comma-joined in the order of the schema: a text for a number, a fraction
    or too large a number for a whole one, anything but an object for an object. Missing fields and nulls are no fault.
    Columns of the same names are replaced; repeated messages have a row each.
    """
    whole = message(F.col("value"))
    payload = F.variant_get("_message", "$.payload", "variant")
    bad = F.array(*[
        F.when(_is_bad(F.col("_message"), f"payload.{path}", wanted), F.lit(path))
        for path, wanted in _fields(ENVELOPE["payload"].dataType)
    ])
    found = records.withColumn("_message", whole).withColumns({
        "city": F.try_variant_get("_message", "$.city", "string"),
        "bad_fields": F.nullif(F.array_join(F.array_compact(bad), ","), F.lit("")),
    })
    reason = (
        F.when(F.col("_message").isNull(), "not_json").when(kind(F.col("_message")) != "object", "not_object")
        .when(F.col("city").isNull(), "no_city").when(F.coalesce(kind(payload) != "object", F.lit(True)), "no_payload")
        .when(F.col("bad_fields").isNotNull(), "bad_field")
    )
    named = F.when(reason == "bad_field", F.col("bad_fields"))
    return found.withColumn("reason", reason).withColumn("bad_fields", named).drop("_message")


def payload_fields(records: DataFrame, depth: int = 3) -> DataFrame:
    """city, field (path below the payload), kind, messages: every field the feed sends, known to the parser or not, and
    how many messages of the city have it with a value of that kind.

    Fields of objects are followed ``depth`` levels down; elements of arrays are not. One pass over the messages: a level's
    field is counted with the first of the fields below it. Messages without an object as payload have no fields.
    """
    spark = records.sparkSession
    none = F.array().cast("array<struct<field:string,kind:string>>")
    rows = records.select(message(F.col("value")).alias("whole")).select(
        F.try_variant_get("whole", "$.city", "string").alias("city"),
        F.variant_get("whole", "$.payload", "variant").alias("whole"), F.lit("").alias("path"), none.alias("fields"),
    )
    for _ in range(depth):
        objects = rows.withColumn("whole", F.when(kind(F.col("whole")) == "object", F.col("whole")))
        below = objects.lateralJoin(spark.tvf.variant_explode_outer(F.col("whole").outer()))
        path = F.concat("path", F.when(F.col("path") == "", "").otherwise("."), "key")
        first = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("fields")).otherwise(none)
        entry = F.when(F.col("key").isNotNull(), F.array(F.struct(path.alias("field"), kind(F.col("value")).alias("kind"))))
        rows = below.select(
            "city", F.col("value").alias("whole"), F.coalesce(path, F.lit("")).alias("path"),
            F.concat(first, F.coalesce(entry, none)).alias("fields"),
        )
    found = rows.select("city", F.inline("fields"))
    return found.groupBy("city", "field", "kind").agg(F.count("*").alias("messages"))
