"""What types the fields of a feed really hold, beside the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.contract import CONTRACT

#: Kinds of JSON values and the columns that count them.
KINDS = {"integer": "integers", "number": "numbers", "text": "texts", "boolean": "booleans", "nested": "nested", "null": "nulls"}


def _kind(type_name: Column) -> Column:
    return (
        F.when(type_name == "BIGINT", "integer")
        .when(type_name.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number")
        .when(type_name == "STRING", "text")
        .when(type_name == "BOOLEAN", "boolean")
        .when(type_name == "VOID", "null")
        .otherwise("nested")
    )


def joined_kind(has: dict[str, Column]) -> Column:
    """Least kind that holds all observed ones: null below all, integer below number, else text above all."""
    kinds = [k for k in KINDS if k != "null"]
    alone = {k: has[k] & ~_any([has[o] for o in kinds if o != k]) for k in kinds}
    numeric = (has["integer"] | has["number"]) & ~_any([has[k] for k in ("text", "boolean", "nested")])
    result = F.when(~_any([has[k] for k in kinds]), "null").when(alone["integer"], "integer").when(numeric, "number")
    for kind in ("boolean", "nested"):
        result = result.when(alone[kind], kind)
    return result.otherwise("text")


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def observed_types(lines: DataFrame) -> DataFrame:
    """One row per field seen in, or missing from, JSON lines (column ``value``): its kinds, and what the contract makes of them.

    A full pass in one aggregate, partial in each task, with a row per field and task in
    the shuffle: no sample, so a single odd value shows. Lines that are not JSON objects,
    null and blank ones count in no field; a contract field that never occurs has zeros.
    ``misfits`` are values that the contract's type rejects, of unknown fields all values;
    a field repeated in an object makes the line invalid.
    """
    objects = lines.select(F.try_parse_json("value").alias("v")).where(
        F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT")
    )
    exploded = objects.lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("v").outer()))
    fields = exploded.select(
        F.col("key").alias("field"),
        F.schema_of_variant("value").alias("type_name"),
        F.try_variant_get("value", "$", "string").alias("text"),
    )
    kind, text = _kind(F.col("type_name")), F.col("text")
    castable = F.lit(False)
    for field, wanted in CONTRACT.items():
        castable = castable | ((F.col("field") == field) & text.try_cast(wanted).isNotNull())
    seen = fields.select("field", kind.alias("kind"), (text.isNotNull() & ~castable).alias("misfit")).groupBy("field").agg(
        *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in KINDS.items()], F.count_if("misfit").alias("misfits")
    )
    contract = lines.sparkSession.createDataFrame(list(CONTRACT.items()), "field string, contract string")
    # the contract has a row per field, fixed by the code
    both = seen.join(F.broadcast(contract), "field", "full_outer")
    counts = {name: F.coalesce(F.col(name), F.lit(0)) for name in (*KINDS.values(), "misfits")}
    merged = joined_kind({kind: F.col(name) > 0 for kind, name in KINDS.items()}).alias("merged")
    return both.withColumns(counts).select("field", "contract", merged, *KINDS.values(), "misfits")
