"""Lineage tables from run manifests: models, documented columns and model-to-model edges, per run.

Edge inputs are resolved within their run by joining the dependency id to the model's fully qualified
name; a run may be spread over several manifests, and a model given twice in a run counts once. A
model that no manifest of the run describes keeps its raw id, with ``resolved`` false. Bronze sources
(ids not starting ``model.``) drop out. Entity ids are stable ``xxhash64`` values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_DATABASE = "main"
UNKNOWN_TYPE = "unknown"


def lineage_models(manifests: DataFrame) -> DataFrame:
    """One row per model; what was left out of the manifests (``read_manifests(without=...)``) gives no columns here."""
    nodes = manifests.select("run_id", F.explode("nodes").alias("unique_id", "n"))
    db = F.coalesce(F.col("n.database"), F.lit(DEFAULT_DATABASE))
    schema = F.coalesce(F.col("n.schema"), F.lit(""))
    fqn = F.concat_ws(".", db, schema, F.col("n.name"))
    out = {"run_id": F.col("run_id"), "unique_id": F.col("unique_id"), "name": F.col("n.name"), "schema_name": schema, "database_name": db,
           "fqn": fqn, "tags": F.array_join(F.coalesce(F.col("n.tags"), F.array()), ","),
           "description": F.coalesce(F.col("n.description"), F.lit("")), "entity_id": F.xxhash64(fqn),
           "_depends_on": F.col("n.depends_on.nodes"), "_columns": F.col("n.columns")}
    read = nodes.schema["n"].dataType.fieldNames()
    fields = {"tags": "tags", "description": "description", "_depends_on": "depends_on", "_columns": "columns"}
    return (nodes.where(F.col("n.resource_type") == "model")
            .select([c.alias(name) for name, c in out.items() if fields.get(name, "name") in read]))


def lineage_columns(models: DataFrame) -> DataFrame:
    cols = models.select("run_id", "fqn", F.explode("_columns").alias("column_name", "c"))
    return cols.select("run_id", F.concat(F.col("fqn"), F.lit("#"), F.col("column_name")).alias("qualified_name"),
                       F.col("fqn").alias("table_fqn"), "column_name",
                       F.coalesce(F.col("c.description"), F.lit("")).alias("description"),
                       F.coalesce(F.col("c.data_type"), F.lit(UNKNOWN_TYPE)).alias("data_type"))


def lineage_edges(models: DataFrame) -> DataFrame:
    """Every model gives one entry that defines its id and one for each id it needs. Entries meet by (run, id) in one
    shuffle, so the manifests are read and parsed once and what defines and what needs an id are not shuffled apart."""
    entry = "array<struct<id:string,output_id:string,fqn:string>>"
    own = F.array(F.struct(F.col("unique_id").alias("id"), F.lit(None).cast("string").alias("output_id"), "fqn")).cast(entry)
    needs = F.filter(F.array_distinct("_depends_on"), lambda d: d.startswith("model."))
    needs = F.transform(needs, lambda d: F.struct(d.alias("id"), F.col("unique_id").alias("output_id"), F.col("fqn").alias("fqn"))).cast(entry)
    entries = models.select("run_id", F.explode(F.concat(own, F.coalesce(needs, F.array().cast(entry)))).alias("e")).select("run_id", "e.*")
    defines = F.col("output_id").isNull()
    found = entries.withColumn("known_fqn", F.min(F.when(defines, F.col("fqn"))).over(Window.partitionBy("run_id", "id")))
    # The partitioning of the window also serves to drop edges given twice.
    return (found.where(~defines).distinct()
            .select("run_id", F.concat(F.lit("process://"), F.col("output_id")).alias("process_name"),
                    F.coalesce("known_fqn", "id").alias("input_fqn"), F.col("fqn").alias("output_fqn"),
                    F.col("known_fqn").isNotNull().alias("resolved")))


def public(df: DataFrame) -> DataFrame:
    return df.select([c for c in df.columns if not c.startswith("_")])
