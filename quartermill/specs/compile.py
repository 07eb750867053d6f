"""Field and tax specifications: defaults, and jobs that compile them from tables."""

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quartermill.functions import formats
from quartermill.operators.sizing import collect_bounded
from quartermill.session import values_frame
from quartermill.specs import fixed_values as fixed

MAX_FIELDS = 2_000
MAX_TAX_CELLS = 200_000

FIELD_SCHEMA = pa.schema(
    [
        ("ord", pa.int32()), ("source_column", pa.string()), ("code", pa.string()),
        ("format", pa.string()), ("width", pa.int32()), ("decimals", pa.int32()),
        ("signed", pa.bool_()), ("date_pattern", pa.string()), ("level", pa.string()),
    ]
)
TAX_SCHEMA = pa.schema(
    [
        ("measure", pa.string()), ("tax_type", pa.string()), ("code", pa.string()),
        ("width", pa.int32()), ("decimals", pa.int32()), ("signed", pa.bool_()),
        ("mandatory", pa.bool_()),
    ]
)
PAIR_SCHEMA = pa.schema(
    [("base_type", pa.string()), ("employee_type", pa.string()), ("employer_type", pa.string())]
)


@dataclass(frozen=True)
class Specs:
    """Specification rows, tens to hundreds of them, as plain tuples in schema order."""

    fields: tuple
    tax: tuple
    pairs: tuple

    def field_frame(self, spark: SparkSession) -> DataFrame:
        return values_frame(spark, FIELD_SCHEMA, self.fields)

    def tax_frame(self, spark: SparkSession) -> DataFrame:
        return values_frame(spark, TAX_SCHEMA, self.tax)

    def pair_frame(self, spark: SparkSession) -> DataFrame:
        return values_frame(spark, PAIR_SCHEMA, self.pairs)

    def mandatory(self) -> dict:
        """code -> (measure, tax type); a repeated code keeps its last row."""
        return {row[2]: (row[0], row[1]) for row in self.tax if row[6]}


def _date_pattern(code: str) -> str:
    return "yyyyMMdd" if code == fixed.YEAR_FIRST_DATE_CODE else "MMddyyyy"


def default_specs() -> Specs:
    fields = []
    for name, code, kind, width, level in fixed.table(fixed.WORKER_FIELDS):
        decimals = fixed.PAY_RATE_DECIMALS if kind == "decimal" else None
        pattern = _date_pattern(code) if kind == "date" else None
        signed = False if kind == "decimal" else None
        fields.append((len(fields), name, code, kind, int(width), decimals, signed, pattern, level))
    for name, code, width in fixed.table(fixed.ADDRESS_FIELDS):
        fields.append((len(fields), name, code, "text", int(width), None, None, None, "EE"))
    tax = [
        (measure, tax_type, code, int(width), int(decimals), signed == "Y", mandatory == "Y")
        for measure, tax_type, code, width, decimals, signed, mandatory in fixed.table(fixed.TAX_CELLS)
    ]
    return Specs(tuple(fields), tuple(tax), tuple(map(tuple, fixed.table(fixed.TAX_PAIRS))))


# --- fields ------------------------------------------------------------------


def source_columns(spark: SparkSession) -> DataFrame:
    """Code -> profile column it is filled from, with the output order of address fields."""
    worker = [(code, name, 0, 0) for name, code, *_ in fixed.table(fixed.WORKER_FIELDS)]
    address = [(code, name, 1, i) for i, (name, code, _) in enumerate(fixed.table(fixed.ADDRESS_FIELDS))]
    schema = pa.schema(
        [("code", pa.string()), ("source_column", pa.string()), ("part", pa.int32()), ("pos", pa.int32())]
    )
    return values_frame(spark, schema, worker + address)


def field_rows(raw: DataFrame) -> DataFrame:
    """Distinct field rows of the raw field table."""
    return raw.select(
        "field_code", "field_length", "data_type", "decimal_places", "signed", "category_1", "category_2"
    ).distinct()


def level_rows(levels: DataFrame) -> DataFrame:
    """Distinct level rows of the quarterly file, for the codes we can fill."""
    codes = source_columns(levels.sparkSession).select(F.col("code").alias("field_code"))
    return (
        levels.filter(F.col("file_code") == fixed.LEVEL_FILE_CODE)
        .select("field_code", "record_code")
        .join(codes, "field_code", "left_semi")
        .distinct()
    )


def _record_level(record_code: Column) -> Column:
    level = F.lit("EE")
    for record, name in fixed.LEVEL_RECORDS.items():
        level = F.when(record_code == record, F.lit(name)).otherwise(level)
    return level


def compile_field_spec(raw: DataFrame, levels: DataFrame) -> DataFrame:
    """Raw field and level tables -> one format row per code.

    Types other than N and X get no format and are left out later.  The first
    record code of a code decides its level; codes without one are EE.  Of
    several rows of a code the one that sorts last counts.
    """
    code_level = level_rows(levels).groupBy("field_code").agg(
        _record_level(F.min("record_code")).alias("level")
    )
    kind = F.col("data_type")
    is_number, is_date = kind == "N", (kind == "X") & (F.col("category_1") == "DATE")
    return (
        field_rows(raw)
        .groupBy("field_code")
        .agg(F.max(F.struct("field_length", "data_type", "decimal_places", "signed", "category_1", "category_2")).alias("row"))
        .select("field_code", "row.*")
        .join(code_level, "field_code", "left")
        .join(
            source_columns(raw.sparkSession).withColumnRenamed("code", "field_code"), "field_code", "left"
        )
        .select(
            F.col("field_code").alias("code"),
            "source_column",
            F.when(is_number, "decimal").when(is_date, "date").when(kind == "X", "text").alias("format"),
            F.when(is_date, F.lit(8)).when(kind.isin("N", "X"), F.col("field_length")).alias("width"),
            F.when(is_number, F.coalesce("decimal_places", F.lit(0))).alias("decimals"),
            F.when(is_number, F.coalesce(F.col("signed") == "Y", F.lit(False))).alias("signed"),
            F.when(
                is_date,
                F.when(F.col("field_code") == fixed.YEAR_FIRST_DATE_CODE, "yyyyMMdd").otherwise("MMddyyyy"),
            ).alias("date_pattern"),
            F.coalesce("level", F.lit("EE")).alias("level"),
        )
    )


# --- taxes -------------------------------------------------------------------


def tax_spec_from_feed(feed: DataFrame, field_spec: DataFrame) -> DataFrame:
    """Mapping feed -> tax cells.

    ``feed`` carries ``seq, tax_code, field_code, token``.  Incomplete rows,
    unknown tokens and codes without a usable field row are dropped; where two
    rows fill the same cell the later one wins.
    """
    spark = feed.sparkSession
    tokens = values_frame(
        spark, pa.schema([("token", pa.string()), ("measure", pa.string())]), fixed.table(fixed.TOKENS)
    )
    complete = feed.filter((F.col("tax_code") != "") & (F.col("field_code") != ""))
    usable = field_spec.filter(F.col("format").isNotNull()).select(
        F.col("code").alias("field_code"), "format", "width", "decimals", "signed"
    )
    # max_by combines on the map side, so a cell repeated in most of the feed is no hot group.
    cells = (
        complete.join(tokens, "token")
        .join(usable, "field_code")
        .groupBy("measure", F.col("tax_code").alias("tax_type"))
        .agg(F.max_by(F.struct("field_code", "format", "width", "decimals", "signed"), "seq").alias("c"))
    )
    return cells.select(
        "measure",
        "tax_type",
        F.col("c.field_code").alias("code"),
        F.col("c.width").alias("width"),
        F.coalesce("c.decimals", F.lit(2)).alias("decimals"),
        F.coalesce("c.signed", F.lit(True)).alias("signed"),
        F.col("c.field_code").isin(*fixed.MANDATORY_CODES).alias("mandatory"),
    )


def tax_pairs(feed: DataFrame) -> DataFrame:
    """Employee/employer pairs: a code ending in EE whose ER twin exists."""
    code = F.col("tax_code")
    base = F.left(code, F.length(code) - 2)
    tail = F.right(code, F.lit(2))
    return (
        feed.filter(tail.isin("EE", "ER"))
        .groupBy(base.alias("base_type"))
        .agg(F.max(tail == "EE").alias("has_employee"), F.max(tail == "ER").alias("has_employer"))
        .filter("has_employee AND has_employer")
        .select(
            "base_type",
            F.concat("base_type", F.lit("EE")).alias("employee_type"),
            F.concat("base_type", F.lit("ER")).alias("employer_type"),
        )
    )


def default_values(spec: DataFrame) -> DataFrame:
    """Default text of every numeric field row."""
    return spec.filter(F.col("format") == "decimal").select(
        "code", F.expr(formats.zero_text("width", "signed")).alias("default_value")
    )


def specs_from_frames(
    fields: DataFrame | None = None, tax: DataFrame | None = None, pairs: DataFrame | None = None
) -> Specs:
    """Specs from compiled tables; a part that is missing or empty uses the default."""
    default = default_specs()
    field_list, tax_list, pair_list = default.fields, default.tax, default.pairs
    if fields is not None:
        usable = fields.filter("format IS NOT NULL AND source_column IS NOT NULL")
        positions = source_columns(fields.sparkSession).select("source_column", "code", "part", "pos")
        rows = collect_bounded(
            usable.join(positions, ["source_column", "code"]), MAX_FIELDS, "field specification"
        )
        # Worker fields in code order, then address fields in their fixed order.
        rows.sort(key=lambda r: (r["part"], r["pos"], r["code"]))
        names = [f.name for f in FIELD_SCHEMA][1:]
        field_list = tuple((i, *(r[n] for n in names)) for i, r in enumerate(rows)) or field_list
    if tax is not None:
        names = [f.name for f in TAX_SCHEMA]
        rows = collect_bounded(tax, MAX_TAX_CELLS, "tax specification")
        tax_list = tuple(tuple(r[n] for n in names) for r in rows) or tax_list
    if pairs is not None:
        rows = collect_bounded(pairs, MAX_TAX_CELLS, "tax pair table")
        pair_list = tuple((r["base_type"], r["employee_type"], r["employer_type"]) for r in rows) or pair_list
    return Specs(field_list, tax_list, pair_list)


# --- expressions -------------------------------------------------------------


def field_text(row: tuple) -> str:
    """SQL text of the coded field of one specification row."""
    _, value, code, kind, width, decimals, signed, pattern, _ = row
    literal = formats.quote(code)
    if kind == "date":
        return formats.date_field(literal, value, pattern)
    if kind == "decimal":
        return formats.decimal_field(literal, value, width, decimals, bool(signed))
    if kind == "number":
        return formats.number_field(literal, value, width, bool(signed))
    if code == fixed.IDENTITY_NUMBER_CODE:
        return formats.identity_field(literal, value)
    if code in fixed.OVERFLOW_CODES and width and width > 0:
        mark, head = fixed.OVERFLOW_CODES[code]
        return formats.overflow_field(literal, value, width, mark, head)
    return formats.text_field(literal, value, width)
