"""Entity files: one JSON object per line, with fixed schemas."""

from __future__ import annotations

from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import fixed, schemas
from touchline.plans.jobs import together
from touchline.sources.scratch import materialize, part_of_written

_CORRUPT = "_corrupt_record"


def empty_entity(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schemas.RAW[name])


def _as_written(schema: T.StructType) -> T.StructType:
    """The same fields as texts: a number may be written as `27`, `"27"` or `27.0`."""
    return T.StructType([T.StructField(field.name, T.StringType()) for field in schema])


def _typed(field: T.StructField, value: Column) -> Column:
    """A text as the field's type, NULL if it is none; a whole number may be written with a fraction."""
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        return F.coalesce(value.try_cast(field.dataType), F.rint(value.try_cast("double")).try_cast(field.dataType))
    return value.try_cast(field.dataType)


def _typed_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[_typed(field, F.col(f"`{field.name}`")).alias(field.name) for field in schema])


def _scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The lines of a file or folder, None if there is none; a line that is no JSON fails the job."""
    try:
        lines = spark.read.schema(_as_written(schema)).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return _typed_rows(lines, schema)


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a given schema. Blank lines are skipped; a line that is no JSON fails the job."""
    rows = _scan(spark, path, schema)
    if rows is None:
        raise FileNotFoundError(path)
    return rows


def read_entity(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The file or folder `<directory>/<name>.jsonl`; an absent one is an empty table.

    With a fixed schema an empty input flows through every later step and gives empty
    tables, so nothing downstream has to ask what is present.
    """
    rows = _scan(spark, f"{directory.rstrip('/')}/{name}.jsonl", schemas.RAW[name])
    return empty_entity(spark, name) if rows is None else rows


def read_entities(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """All seven entities. Raises if not one of them holds a row."""
    return _filled({name: read_entity(spark, directory, name) for name in schemas.ENTITIES}, directory)


def read_good_lines(spark: SparkSession, directory: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All seven entities without the lines that are no JSON, and those lines by entity."""
    steps = [partial(split_malformed, spark, directory, name) for name in schemas.ENTITIES]
    split = dict(zip(schemas.ENTITIES, together(spark, *steps)))
    good = _filled({name: rows for name, (rows, _) in split.items()}, directory)
    return good, {name: lines for name, (_, lines) in split.items()}


def _filled(raw: dict[str, DataFrame], directory: str) -> dict[str, DataFrame]:
    if all(rows.isEmpty() for rows in raw.values()):
        raise FileNotFoundError(f"no entity rows found in {directory}")
    return raw


def split_malformed(spark: SparkSession, directory: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines) of an entity, for loads that set bad lines aside. Each line is parsed once:
    the rows are written, with the line beside them where it is malformed, and both results are selections."""
    try:
        lines = spark.read.text(f"{directory.rstrip('/')}/{name}.jsonl").where("trim(value) <> ''")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value STRING")
    schema = schemas.RAW[name]
    parsed = T.StructType([*_as_written(schema).fields, T.StructField(_CORRUPT, T.StringType())])
    rows = lines.select("value", F.from_json("value", parsed, {"mode": "PERMISSIVE"}).alias("row"))
    typed = [_typed(field, F.col(f"row.`{field.name}`")).alias(field.name) for field in schema]
    malformed = F.when(F.col(f"row.{_CORRUPT}").isNotNull(), F.col("value"))
    table = materialize(rows.select(*typed, malformed.alias(_CORRUPT)), name)
    good = part_of_written(table.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT))
    return good, table.where(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("line"))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """The competition seeds: JSON lines of (type, href)."""
    return read_lines(spark, path, T.StructType([schemas.RAW["competitions"][c] for c in ("type", "href")]))


def default_seeds(spark: SparkSession) -> DataFrame:
    """The built-in competition seeds."""
    return spark.createDataFrame([("competition", href) for href in fixed.SEED_HREFS], "type STRING, href STRING")


def write_entity(df: DataFrame, directory: str, name: str) -> None:
    """Write an entity as UTF-8 JSON lines, dates in ISO form. The files, one per task, are packed by gzip, as lines
    repeat their field names; readers take packed and plain files alike."""
    packed = df.write.mode("overwrite").option("compression", "gzip")
    packed.json(f"{directory.rstrip('/')}/{name}.jsonl")
