"""Cells of unknown shape (A9, A10, N4): JSON text as VARIANT instead of a fixed struct.

A fixed schema drops what it doesn't name and turns a value of another type into
NULL. A variant keeps the whole cell; fields are taken out when they are needed,
and what could not be read is told apart from what was not there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions.text import _c

#: What became of a field of a cell.
READ, NULL, MISSING, WRONG, UNREADABLE = "read", "null", "missing", "wrong type", "unreadable cell"


def parsed(cell) -> Column:
    """JSON text -> variant; NULL for a NULL cell and for text that is not one JSON value.

    The parser stops after the first value and ignores what follows. So the cell is
    read as the one value of an object and as the one element of an array: text
    that would end the one early is an error in the other.
    """
    c = _c(cell)
    whole = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    alone = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    return F.when(alone, F.try_variant_get(whole, "$.v", "variant"))


def field(variant, path: str, as_type: str) -> Column:
    """A field of a variant as a type; NULL where it can't be read (see `outcome`)."""
    return F.try_variant_get(_c(variant), path, as_type)


def outcome(cell, variant, path: str, as_type: str) -> Column:
    """What became of `field`: one of READ, NULL (a JSON null or a NULL cell), MISSING, WRONG, UNREADABLE."""
    whole, part = _c(variant), F.try_variant_get(_c(variant), path, "variant")
    return (
        F.when(_c(cell).isNull(), NULL).when(whole.isNull(), UNREADABLE).when(F.coalesce(F.is_variant_null(part), F.lit(False)), NULL)
        .when(part.isNull(), MISSING).when(field(whole, path, as_type).isNull(), WRONG).otherwise(READ)
    )


def with_fields(df: DataFrame, cell: str, fields: dict[str, tuple[str, str]], keep: str | None = None) -> DataFrame:
    """Adds each of `fields` (name -> (path, type)) of a JSON cell and `<name>_outcome`;
    `keep` names a column for the variant itself. Each cell is parsed once."""
    v = keep or f"_variant_of_{cell}"
    out = df.withColumn(v, parsed(F.col(f"`{cell}`")))
    for name, (path, as_type) in fields.items():
        out = out.withColumn(name, field(F.col(f"`{v}`"), path, as_type)).withColumn(
            f"{name}_outcome", outcome(F.col(f"`{cell}`"), F.col(f"`{v}`"), path, as_type))
    return out if keep else out.drop(v)


def back_to_text(variant) -> Column:
    """Variant -> JSON text, keys that nobody asked for included."""
    return F.to_json(_c(variant))


def shape(df: DataFrame, cell: str) -> DataFrame:
    """One row: the schema that holds all cells, how many there are, and how many are no JSON."""
    v = parsed(F.col(f"`{cell}`"))
    return df.select(F.col(f"`{cell}`").alias("_cell"), v.alias("_v")).agg(
        F.schema_of_variant_agg("_v").alias("shape"), F.count("_cell").alias("n_cells"),
        F.coalesce(F.sum((F.col("_cell").isNotNull() & F.col("_v").isNull()).cast("bigint")), F.lit(0)).alias("n_unreadable"))
