"""Feature collections in and out."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave import schemas


def read_collections(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Collection documents: whole files with ``multiline``, else one per line."""
    reader = spark.read.schema(schema or schemas.feature_collection())
    return reader.option("multiLine", multiline).json(path)


def explode_features(documents: DataFrame) -> DataFrame:
    """One row per feature, in a struct column ``feature``, with coordinates of one nesting."""
    return as_multi_polygons(documents.select(F.explode("features").alias("feature")))


def as_multi_polygons(features: DataFrame) -> DataFrame:
    """Every polygon as a multi-polygon of one, so that both have one type.

    Coordinates may be JSON text, polygons or already multi-polygons. A geometry of another
    kind, or one whose text can't be read, has NULL coordinates and keeps its type.
    """
    kind = features.select("feature.geometry.coordinates").schema[0].dataType
    own, shape = F.col("feature.geometry.coordinates"), F.col("feature.geometry.type")
    if kind == schemas.MULTI_POLYGON:
        return features
    if isinstance(kind, T.StringType):
        whole = F.when(
            shape == "Polygon", F.array(F.from_json(own, schemas.POLYGON))
        ).when(shape == "MultiPolygon", F.from_json(own, schemas.MULTI_POLYGON))
    else:
        whole = F.when(own.isNotNull(), F.array(own))
    # Text that can't be read gives an array of one NULL.
    read = F.filter(whole, lambda polygon: polygon.isNotNull())
    known = F.when(F.size(read) > 0, read)
    name = F.when(known.isNotNull(), "MultiPolygon").otherwise(shape)
    geometry = F.struct(name.alias("type"), known.alias("coordinates"))
    return features.withColumn("feature", F.col("feature").withField("geometry", geometry))


def collections(features: DataFrame, per_document: int = 1000) -> DataFrame:
    """Collection documents (JSON text ``value``) of at most ``per_document`` features.

    Features are turned to JSON by Spark and only joined here, partition by
    partition and without a shuffle: no document outgrows its bound, and a task
    that is run again writes the same features again.
    """

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = (text for batch in batches for text in batch["value"])
        while chunk := list(islice(texts, per_document)):
            body = ",".join(chunk)
            document = f'{{"type":"FeatureCollection","features":[{body}]}}'
            yield pd.DataFrame({"value": [document]})

    texts = features.select(F.to_json("feature").alias("value"))
    return texts.mapInPandas(assemble, "value string")


def write_collections(
    features: DataFrame,
    path: str,
    per_document: int = 1000,
    mode: str = "errorifexists",
    partitions: int | None = None,
) -> None:
    """Write one document per line; with ``partitions`` in so many files."""
    if partitions:
        features = features.repartition(partitions)
    collections(features, per_document).write.mode(mode).text(path)
