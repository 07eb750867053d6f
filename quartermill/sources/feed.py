"""Tax-code mapping feed, read from a landed JSON table."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEYS = ("taxCode", "fieldCode", "token")


def _schema(keys: tuple[str, str, str]) -> str:
    return ", ".join(f"`{key}` STRUCT<code: STRING>" for key in keys)


def _columns(keys: tuple[str, str, str], at: str = "") -> list:
    return [F.col(f"{at}`{key}`.code").alias(name) for key, name in zip(keys, ("tax_code", "field_code", "token"))]


def parse_feed(lines: DataFrame, text: str = "value", order: str = "seq", keys: tuple[str, str, str] = KEYS) -> DataFrame:
    """JSON text rows with an order column -> ``seq, tax_code, field_code, token``.

    ``keys`` are the feed's names of the tax code, the field code and the token.
    """
    items = lines.select(F.col(order).alias("seq"), F.from_json(text, _schema(keys)).alias("item"))
    return items.select("seq", *_columns(keys, "item."))


def read_feed(spark: SparkSession, path: str, keys: tuple[str, str, str] = KEYS) -> DataFrame:
    """One JSON object per line, with its feed order in ``seq``.

    Rows without ``seq`` get the read order, which is the feed order only while
    the feed is a single file; a feed landed in parts must carry ``seq``.
    """
    raw = spark.read.schema(f"seq BIGINT, {_schema(keys)}").json(path)
    return raw.select(F.coalesce("seq", F.monotonically_increasing_id()).alias("seq"), *_columns(keys))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The feed's raw lines for ``checked``: ``seq`` (read order), ``file`` and ``value``."""
    lines = spark.read.text(path)
    return lines.select(F.monotonically_increasing_id().alias("seq"), F.col("_metadata.file_path").alias("file"), "value")


def checked(lines: DataFrame, text: str = "value", keys: tuple[str, str, str] = KEYS) -> DataFrame:
    """``lines`` with the struct ``item`` (tax_code, field_code, token) and the ``reason`` why a line is of no use, or NULL.

    Reasons, the first that holds: ``empty`` (NULL or blanks), ``malformed``
    (no JSON object of the feed's shape), ``no <key>`` (the key or its code is
    absent, NULL or empty).  One projection: nothing is parsed twice or shuffled.
    """
    parsed = F.from_json(text, f"{_schema(keys)}, _unreadable STRING", {"columnNameOfCorruptRecord": "_unreadable"})
    found = lines.withColumn("_item", parsed)
    reason: Column = F.when(F.coalesce(F.trim(text), F.lit("")) == "", "empty")
    reason = reason.when(F.col("_item").isNull() | F.col("_item._unreadable").isNotNull(), "malformed")
    for key in keys:
        reason = reason.when(F.coalesce(F.col(f"_item.`{key}`.code"), F.lit("")) == "", f"no {key}")
    item = F.struct(*_columns(keys, "_item."))
    return found.withColumn("reason", reason).withColumn("item", F.when(F.col("reason").isNull(), item)).drop("_item")


def rejects(checked_lines: DataFrame) -> DataFrame:
    """The lines of no use with all columns that tell their place, their text and the reason."""
    return checked_lines.filter("reason IS NOT NULL").drop("item")


def accepted(checked_lines: DataFrame, order: str = "seq") -> DataFrame:
    """The other lines as ``parse_feed`` gives them."""
    return checked_lines.filter("reason IS NULL").select(F.col(order).alias("seq"), "item.*")
