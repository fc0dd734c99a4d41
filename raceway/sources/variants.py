"""Raw JSON kept as it came: a VARIANT per record, from which typed values are taken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_json_records(spark: SparkSession, path: str, out: str = "record") -> DataFrame:
    """One VARIANT per JSON record, read once and without a schema. A record that does not parse raises.

    It can be written to Parquet and read back as it is.
    """
    reader = spark.read.option("singleVariantColumn", out).option("mode", "FAILFAST")
    return reader.json(path)


def field(record: str, name: str, kind: str) -> Column:
    """A field as a type; NULL where it is absent, null, or no such value."""
    return F.try_variant_get(record, _path(name), kind)


def mixed(record: str, name: str) -> Column:
    """A field that holds numbers as well as text: a struct of kind, number and text.

    ``kind`` is number, text, boolean, null (the field holds JSON's null), absent (there is no such field) or other
    (an object or a list). ``number`` is set for numbers only, so the text "12" stays text; ``text`` is the
    value as text, JSON for other.
    """
    value = F.try_variant_get(record, _path(name), "variant")
    told = F.schema_of_variant(value)
    kind = (
        F.when(value.isNull(), "absent")
        .when(F.is_variant_null(value), "null")
        .when(told == "STRING", "text")
        .when(told == "BOOLEAN", "boolean")
        .when(told.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\()"), "number")
        .otherwise("other")
    )
    as_text = F.try_variant_get(record, _path(name), "string")
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "number", field(record, name, "double")).alias("number"),
        F.when(kind == "other", F.to_json(value)).otherwise(as_text).alias("text"),
    )


def _path(name: str) -> str:
    """A path has no escapes; a name with both kinds of quotes cannot be told."""
    quote = "'" if "'" not in name else '"'
    if quote in name:
        raise ValueError(f"field {name}")
    return f"$[{quote}{name}{quote}]"
