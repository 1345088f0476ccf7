"""Index mappings and bulk request text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.functions.types import target_type
from tidefold.model import DATE_FORMAT, DELETE, INSERT, UPDATE

# Change op -> bulk action.
BULK_ACTIONS = {INSERT: "index", UPDATE: "update", DELETE: "delete"}
# End of fixed values.

# Dates as the mapping's format has them; binary fields are base64 text.
JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}


def type_mapping(catalog: DataFrame) -> DataFrame:
    """Catalog columns with their index type and, for dates, its format."""
    typed = catalog.withColumn("target_type", target_type(F.col("type")))
    return typed.withColumn("format", F.when(F.col("target_type") == "date", DATE_FORMAT))


def index_mapping(catalog: DataFrame) -> DataFrame:
    """One mapping document per table.

    A table has at most a few thousand columns, so gathering them is bounded.
    """
    field = F.struct(F.col("target_type").alias("type"), "format")
    entry = F.struct("position", F.struct(F.col("name").alias("key"), field.alias("value")).alias("e"))
    entries = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"])
    properties = type_mapping(catalog).groupBy("tbl").agg(F.map_from_entries(entries).alias("p"))
    document = F.struct(F.struct(F.col("p").alias("properties")).alias("mappings"))
    return properties.select("tbl", F.to_json(document).alias("mapping"))


def document(columns: Sequence[str], present: str | None = None) -> SparkColumn:
    """JSON text of a document, nulls included.

    With ``present``, the name of a column that lists the fields a document has,
    the others are left out; a null that is listed stays.
    """
    if present is None:
        return F.to_json(F.struct(*columns), JSON)
    # Each field as a document of its own, without the braces.
    fields = [
        F.when(
            F.array_contains(present, c),
            F.regexp_extract(F.to_json(F.struct(c), JSON), r"(?s)^\{(.*)\}$", 1),
        )
        for c in columns
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def bulk_lines(index: SparkColumn, document: SparkColumn, id: str = "_id") -> SparkColumn:
    """Bulk text of a change: an action line, then the document for an insert or
    ``{"doc": …}`` for an update; a delete has no second line."""
    op = F.col("op")
    action = F.create_map(*[F.lit(x) for pair in BULK_ACTIONS.items() for x in pair])[op]
    target = F.to_json(F.create_map(action, F.struct(index.alias("_index"), F.col(id).alias("_id"))))
    wrapped = F.concat(F.lit('{"doc":'), document, F.lit("}"))
    return F.concat_ws("\n", target, F.when(op == INSERT, document).when(op == UPDATE, wrapped))
