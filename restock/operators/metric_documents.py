"""Metrics as nested JSON documents, and back as key-value rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metadata entries that go with imported metrics.
CONTEXT_KEYS = [
    "model_type",
    "device",
    "xgboost_objective",
    "tweedie_variance_power",
    "advanced_features_enabled",
    "target_definition",
]


def metrics_document(
    final: DataFrame, uncalibrated: DataFrame, segments: DataFrame, extras: dict | None = None
) -> DataFrame:
    """One row with the JSON text of a run: metrics, ``uncalibrated`` and ``segments.<name>``."""
    named = F.struct("rows", "mae", "rmse", "wmape", "bias")
    by_segment = segments.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("segment", named.alias("metrics"))))).alias("m")
    ).scalar()
    others = [(value if hasattr(value, "cast") else F.lit(value)).alias(name) for name, value in (extras or {}).items()]
    document = F.struct(
        *final.columns,
        *others,
        uncalibrated.select(F.struct(*uncalibrated.columns)).scalar().alias("uncalibrated"),
        by_segment.alias("segments"),
    )
    return final.select(F.to_json(document).alias("value"))


def metrics_flatten(documents: DataFrame, text: str = "value") -> DataFrame:
    """Numeric entries of JSON objects, at any depth, as (metric_name, metric_value).

    Names of nested entries are joined with ``_``, booleans count as 0 and 1, everything else is
    dropped, numbers written as text included. If a document gives one name twice, as a nested entry
    and beside the nest, the deeper one stands. Documents are small; each level is looked at once to
    see whether another one follows.
    """
    document = F.monotonically_increasing_id().alias("document")
    level = documents.select(document, F.lit("").alias("prefix"), F.parse_json(text).alias("node"))
    leaves = []
    while not leaves or not level.isEmpty():
        # The output columns of the table function are pos, key and value.
        entries = level.lateralJoin(level.sparkSession.tvf.variant_explode(F.col("node").outer()))
        named = entries.select(
            "document",
            F.when(F.col("prefix") == "", F.col("key")).otherwise(F.concat_ws("_", "prefix", "key")).alias("prefix"),
            F.col("value").alias("node"),
            F.schema_of_variant("value").alias("kind"),
        )
        numeric = F.col("kind").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
        number = F.when(F.col("kind") == "BOOLEAN", F.try_variant_get("node", "$", "boolean").cast("double")).when(
            numeric, F.try_variant_get("node", "$", "double")
        )
        depth = F.lit(len(leaves)).alias("depth")
        leaves.append(
            named.select("document", depth, F.col("prefix").alias("metric_name"), number.alias("metric_value"))
        )
        level = named.filter(F.col("kind").startswith("OBJECT")).select("document", "prefix", "node")
    rows = leaves[0]
    for deeper in leaves[1:]:
        rows = rows.unionByName(deeper)
    given = rows.filter(F.col("metric_value").isNotNull()).groupBy("document", "metric_name")
    return given.agg(F.max_by("metric_value", "depth").alias("metric_value")).drop("document")


def metrics_import(
    documents: DataFrame, metadata: DataFrame | None, model_key: int, files: dict[str, str] | None = None
) -> DataFrame:
    """Flattened metrics as evaluation rows of the eval split, described by the run's metadata.

    ``files`` names the files they came from (``metrics_file``, ``metadata_file``) for the context.
    """
    rows = metrics_flatten(documents)
    if metadata is None:
        context = F.create_map().cast("map<string,string>")
    else:
        entry = lambda key: F.get_json_object("value", f"$.{key}")
        pairs = [part for key in CONTEXT_KEYS for part in (F.lit(key), entry(key))]
        count = F.json_array_length(entry("feature_columns")).cast("string")
        context = metadata.select(F.create_map(*pairs, F.lit("feature_count"), count)).scalar()
    if files:
        named = F.create_map(*[F.lit(part) for entry in files.items() for part in entry])
        context = F.map_concat(context, named)
    return rows.select(
        F.lit(model_key).alias("model_key"),
        F.lit("eval").alias("evaluation_split"),
        "metric_name",
        "metric_value",
        context.alias("metric_context"),
    )
