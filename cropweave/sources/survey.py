"""Survey responses, and the requests they answer.

Fetching is outside the library: responses are landed as JSON documents
``{"data": [...]}`` and read from there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave import schemas
from cropweave.operators.sets import missing_keys


BROKEN = "_broken"
WITH_BROKEN = T.StructType([*schemas.SURVEY_PAYLOAD, T.StructField(BROKEN, T.StringType())])


def read_payloads(spark: SparkSession, path: str, on_broken: str = "error") -> DataFrame:
    """One row per survey record from landed response files.

    A file that is no whole JSON document fails the job, naming the file, or is left out
    with ``on_broken='drop'``; ``broken_files`` lists them.
    """
    files = _files(spark, path).select(F.col("_metadata.file_path").alias("file"), _parsed("text").alias("response"))
    return _records(files, F.col("response.data"), F.col(f"response.{BROKEN}"), F.col("file"), on_broken)


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``text`` of the landed files that are no whole JSON document."""
    texts = _files(spark, path).select(F.col("_metadata.file_path").alias("file"), "text")
    return broken_payloads(texts, "text")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "text")


def parse_payloads(
    df: DataFrame, payload: str = "payload", on_broken: str = "error", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per survey record from a column of response texts, beside the columns to keep.

    A text that is no whole JSON document fails the job or is left out, as in
    ``read_payloads``; ``broken_payloads`` has those rows.
    """
    return _records(
        df.select(*keep, payload, _parsed(payload).alias("response")),
        F.col("response.data"),
        F.col(f"response.{BROKEN}"),
        F.col(payload),
        on_broken,
        keep,
    )


def broken_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows whose response is no whole JSON document; an answer without data is whole.

    An empty text is no response at all.
    """
    parsed = df.withColumn("_response", _parsed(payload))
    return parsed.filter(F.col(f"_response.{BROKEN}").isNotNull()).drop("_response")


def _parsed(payload: str) -> Column:
    return F.from_json(payload, WITH_BROKEN, {"columnNameOfCorruptRecord": BROKEN})


def _records(
    documents: DataFrame,
    data: Column,
    broken: Column,
    source: Column,
    on_broken: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    if on_broken not in ("error", "drop"):
        raise ValueError("on_broken is 'error' or 'drop'")
    if on_broken == "error":
        failure = F.raise_error(F.concat(F.lit("broken response: "), source))
        data = F.when(broken.isNotNull(), failure.cast(schemas.SURVEY_PAYLOAD["data"].dataType)).otherwise(data)
    # A response without ``data`` gives no rows.
    return documents.select(*keep, F.explode(data).alias("record")).select(*keep, "record.*")


def request_plan(
    weather: DataFrame, level: str = "STATE", date: str = "Date"
) -> DataFrame:
    """The requests needed to cover the panel: one per region, with its year span.

    The span is that of the whole panel and includes its last year.
    """
    keys = {"NATIONAL": [], "STATE": ["State"], "COUNTY": ["State", "County"]}[level]
    years = weather.agg(
        F.struct(
            F.min(F.year(date)).alias("year_min"), F.max(F.year(date)).alias("year_max")
        )
    )
    if keys:
        regions = weather.select(*keys).dropna().distinct()
    else:
        regions = weather.sparkSession.range(1).select()
    span = years.scalar()
    return regions.select(
        F.lit(level).alias("agg_level"),
        *[F.upper(key).alias(key) for key in keys],
        span.getField("year_min").alias("year_min"),
        span.getField("year_max").alias("year_max"),
    )


def reconcile_requests(
    plan: DataFrame, landed: DataFrame, keys: Sequence[str], broken: DataFrame | None = None
) -> DataFrame:
    """How many planned requests have landed, came back broken, or remain.

    ``broken`` has the keys of broken responses; a request that also has a whole one is landed.
    """
    answered = landed.select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = plan.join(answered, list(keys), "left").withColumn("_bad", F.lit(None).cast("boolean"))
    if broken is not None:
        spoilt = broken.select(*keys).distinct().withColumn("_bad", F.lit(True))
        joined = joined.drop("_bad").join(spoilt, list(keys), "left")
    status = F.when(F.col("_hit"), "landed").when(F.col("_bad"), "broken").otherwise("remaining")
    return (
        joined.groupBy(status.alias("status"))
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def missing_requests(
    plan: DataFrame, landed: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Planned requests without any landed record."""
    return missing_keys(plan, landed, keys)
