"""Scans of the raw landing zone: access logs and quoted CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions import fixed_values as V
from ..functions.texts import typed
from . import split_csv

# No line holds a line feed, so it can part the captured fields.
_FIELD_BREAK = "\n"
_BROKEN = "_broken"


def parse_log_lines(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Access log lines (column ``value``) to nine columns, after those to ``keep``.

    The expression rewrites a matching line once into its nine fields; a line
    that does not match stays in one piece and becomes a row of NULLs. Going
    through ``explode_outer`` keeps later filters from repeating the match.

    ``-`` reads as NULL for ident and user. Referrer and bytes keep it: there
    it means "direct" and "no body".
    """
    fields = F.split(
        F.regexp_replace("value", V.LOG_LINE, _FIELD_BREAK.join(f"${i}" for i in range(1, 10))),
        _FIELD_BREAK,
    )
    parsed = lines.select(*keep, F.explode_outer(F.array(fields)).alias("f"))
    whole = F.size("f") == 9
    at = {name: F.when(whole, F.get("f", F.lit(i))) for i, name in enumerate(schemas.RAW_WEB_COLUMNS)}
    at["http_status"] = typed(at["http_status"], "int")
    for name in ("rfc_ident", "auth_user"):
        at[name] = F.nullif(at[name], F.lit("-"))
    return parsed.select(*keep, *[c.alias(name) for name, c in at.items()])


def scan_clf(spark: SparkSession, path: str) -> DataFrame:
    """Access log directory, one line per request, no header."""
    return parse_log_lines(spark.read.text(path))


def csv_text(
    reader, path: str, schema: T.StructType, header: bool = True, escape: str = "\\", multi_line: bool = False, short: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """CSV columns as text, bound by position, through a batch or stream reader.

    A blank field is an empty text. A record that lacks its last fields is set
    aside: it is left out, and with ``short`` only such records come, as far as
    they go. With ``multi_line`` quoted fields may hold line breaks; a file then
    is one task (``quoted_csv`` cuts it). ``with_file`` adds the column ``_file``.
    """
    read = (
        reader.schema(_with_broken(schema))
        .option("columnNameOfCorruptRecord", _BROKEN)
        .option("header", header)
        .option("enforceSchema", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", escape)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .csv(path)
    )
    if with_file:
        read = read.withColumn("_file", F.col("_metadata.file_path"))
    return _whole_records(read, schema, short, ("_file",) if with_file else ())


def _with_broken(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])


def _whole_records(read: DataFrame, schema: T.StructType, short: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    blank = F.col(_BROKEN).isNull()
    lacking = F.col(_BROKEN).isNotNull() & F.col(schema.names[-1]).isNull()
    read = read.filter(lacking if short else ~lacking)
    return read.select(*[F.when(blank & F.col(c).isNull(), F.lit("")).otherwise(F.col(c)).alias(c) for c in schema.names], *keep)


def quoted_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, short: bool = False, with_file: bool = False,
) -> DataFrame:
    """The same rows as ``csv_text`` with ``multi_line`` and doubled quotes, from several tasks per file.

    ``with_file`` adds the column ``_file``.
    """
    found = split_csv.records(spark, path)
    found = found.filter(~F.col("first")) if header else found
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _with_broken(schema))
    parsed = found.select(F.col("file").alias("_file"), split_csv.fields(F.col("text"), columns, columnNameOfCorruptRecord=_BROKEN).alias("_r"))
    return _whole_records(parsed.select("_file", "_r.*"), schema, short, ("_file",) if with_file else ())


def scan_sensor_csv(spark: SparkSession, path: str, header: bool = True, escape: str = '"', **options: bool) -> DataFrame:
    """Sensor readings; quotes inside a field are doubled unless ``escape`` says otherwise."""
    return csv_text(spark.read, path, schemas.RAW_SENSOR, header, escape, **options)


def scan_social_csv(
    spark: SparkSession, path: str, header: bool = True, escape: str = '"', multi_line: bool = True, **options: bool,
) -> DataFrame:
    """Social posts. Texts hold line breaks; quotes inside a field are doubled unless ``escape`` says otherwise.

    Files with doubled quotes are read in several tasks each.
    """
    if multi_line and escape == '"':
        return quoted_csv(spark, path, schemas.RAW_SOCIAL, header, **options)
    return csv_text(spark.read, path, schemas.RAW_SOCIAL, header, escape, multi_line, **options)


def scan_device_csv(spark: SparkSession, path: str, header: bool = True, escape: str = '"', **options: bool) -> DataFrame:
    """Device registry; quotes inside a field are doubled unless ``escape`` says otherwise."""
    return csv_text(spark.read, path, schemas.RAW_DEVICE, header, escape, **options)


def type_sensor(raw: DataFrame) -> DataFrame:
    """Text columns to the declared types; blanks become NULL. ``ts`` stays text."""
    kinds = {"reading_id": "bigint", "temperature": "double", "humidity": "double", "is_duplicate": "boolean"}
    return raw.withColumns({n: typed(n, k) for n, k in kinds.items()})


def type_social(raw: DataFrame) -> DataFrame:
    longs = ("tweet_id", "followers", "likes", "retweets", "replies", "impressions")
    return raw.withColumns({n: typed(n, "bigint") for n in longs} | {"verified": typed("verified", "boolean")})


def type_device(raw: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in schemas.PROCESSED["device_metadata"]}
    return raw.select(*[n if k == "string" else typed(n, k).alias(n) for n, k in kinds.items()])
