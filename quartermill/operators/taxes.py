"""Tax side: latest run, jurisdictions, profile, canonical types, coded fields."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quartermill.functions import formats
from quartermill.functions.text import jurisdiction
from quartermill.session import values_frame
from quartermill.specs import fixed_values as fixed
from quartermill.specs.compile import Specs

ZERO_DEFAULT = (
    "qtd_amount", "qtd_taxable_amount", "qtd_subject_amount", "qtd_gross_wages",
    "qtd_overtime_amount", "ytd_amount", "ytd_taxable_amount", "ytd_subject_amount",
    "ytd_gross_wages", "ytd_overtime_amount",
)
STRICT_KEYS = (
    "worker_sk", "organization_unit_sk", "tax_type", "is_employer_tax", "year", "quarter",
    "payroll_run_sk",
)
RUN_KEYS = (
    "worker_sk", "organization_unit_sk", "state_code", "local_code", "tax_type",
    "is_employer_tax", "year", "quarter",
)
PROFILE_KEYS = ("worker_sk", "branch_code", "company_code")
PROFILE_VALUES = ("filing_status", "number_of_allowances", "sui_exempt_flag", "sdi_exempt_flag")
AMOUNT = "DECIMAL(18,2)"
FILING_CODE = (
    "CASE filing_status WHEN 'MarriedFilingJointly' THEN 'M' WHEN 'HeadOfHousehold' THEN 'H' ELSE 'S' END"
)
COMPLETE = " AND ".join(f"{key} IS NOT NULL" for key in STRICT_KEYS)


def rank_one(snapshot: DataFrame) -> DataFrame:
    """Rows of the last payroll run per key; ties stay, NULL jurisdictions are equal.

    A rank instead of the aggregate-and-join-back of the same table: one scan,
    one shuffle, and Spark limits each key to rank 1 before shuffling too.
    """
    window = Window.partitionBy(*RUN_KEYS).orderBy(F.desc("payroll_run_sk"))
    return snapshot.withColumn("run_rank", F.rank().over(window)).filter("run_rank = 1").drop("run_rank")


def top_runs(snapshot: DataFrame) -> DataFrame:
    """The same rows by a keyed maximum and a semi join back.

    For hot workers: the maximum combines before the shuffle, and the join back
    never gathers a key, however many rows share its last run.
    """
    keys = list(RUN_KEYS)
    top = snapshot.groupBy(*keys).agg(F.max("payroll_run_sk").alias("top_run"))
    same = F.expr(" AND ".join(f"s.{k} <=> t.{k}" for k in keys) + " AND s.payroll_run_sk <=> t.top_run")
    return snapshot.alias("s").join(top.alias("t"), same, "left_semi")


def latest_run(snapshot: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Latest rows; rows with a NULL strict key never match themselves and drop out.

    ``hot`` names the workers with too many rows for one task.
    """
    complete = snapshot.filter(COMPLETE)
    if hot is None:
        return rank_one(complete)
    keys = hot
    usual = rank_one(complete.join(keys, "worker_sk", "left_anti"))
    return usual.unionByName(top_runs(complete.join(keys, "worker_sk", "left_semi")))


def with_amounts(latest: DataFrame) -> DataFrame:
    """Jurisdiction, zero defaults, non-zero counts and the out-of-state amounts.

    The JSON column is parsed once; absent and unreadable values are zero.
    """
    keys = fixed.OUT_OF_STATE_KEYS
    fields = ", ".join(f"{key} STRING" for key in keys.values())
    kept = [n for n in latest.columns if n not in (*ZERO_DEFAULT, "out_of_state")]
    parsed = latest.selectExpr(
        *kept,
        *(f"coalesce({n}, CAST(0 AS {AMOUNT})) AS {n}" for n in ZERO_DEFAULT),
        f"{jurisdiction('state_code', 'local_code')} AS jurisdiction",
        f"from_json(out_of_state, '{fields}') AS oos",
    )
    return parsed.selectExpr(
        *(n for n in parsed.columns if n != "oos"),
        "CASE WHEN qtd_amount <> 0 THEN 1 END AS qtd_amount_count",
        "CASE WHEN ytd_amount <> 0 THEN 1 END AS ytd_amount_count",
        *(f"coalesce(try_cast(oos.{key} AS {AMOUNT}), CAST(0 AS {AMOUNT})) AS {n}" for n, key in keys.items()),
    )


def value_report(fields: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Per period: fields cut because they overflow, and JSON amounts that are no numbers."""
    unreadable = " OR ".join(
        f"(oos.{key} IS NOT NULL AND try_cast(oos.{key} AS {AMOUNT}) IS NULL)" for key in fixed.OUT_OF_STATE_KEYS.values()
    )
    keys = ", ".join(f"{key} STRING" for key in fixed.OUT_OF_STATE_KEYS.values())
    cut = fields.selectExpr("year", "quarter", "CAST(overflow AS BIGINT) AS cut", "0L AS unreadable")
    bad = snapshot.selectExpr("year", "quarter", f"from_json(out_of_state, '{keys}') AS oos").selectExpr(
        "year", "quarter", "0L AS cut", f"CAST(coalesce({unreadable}, false) AS BIGINT) AS unreadable"
    )
    return cut.unionAll(bad).groupBy("year", "quarter").agg(
        F.sum("cut").alias("overflow_count"), F.sum("unreadable").alias("unreadable_count")
    )


def join_profile(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """Left join of the tax profile; NULL jurisdictions match each other."""
    left = rows.alias("t")
    right = profile.select(*PROFILE_KEYS, "state_code", "local_code", *PROFILE_VALUES).alias("p")
    condition = F.expr(
        " AND ".join(f"t.{key} = p.{key}" for key in PROFILE_KEYS)
        + " AND t.state_code <=> p.state_code AND t.local_code <=> p.local_code"
    )
    values = [f"p.{name}" for name in PROFILE_VALUES[1:]]
    return left.join(right, condition, "left").selectExpr(
        "t.*", f"{FILING_CODE} AS filing_status", *values
    )


def join_profile_by_worker(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """The same join for rows already partitioned by worker.

    Joining on ``worker_sk`` alone keeps that partitioning; the few profiles of
    a worker travel as an array and the matching ones are picked from it.
    """
    values = ", ".join(PROFILE_VALUES)
    profiles = profile.groupBy("worker_sk").agg(
        F.expr(f"collect_list(struct(branch_code, company_code, state_code, local_code, {values})) AS profiles")
    )
    match = (
        "filter(profiles, p -> p.branch_code = branch_code AND p.company_code = company_code "
        "AND p.state_code <=> state_code AND p.local_code <=> local_code)"
    )
    joined = rows.join(profiles, "worker_sk", "left")
    picked = joined.selectExpr(*rows.columns, f"explode_outer({match}) AS p")
    return picked.selectExpr(
        *rows.columns, *(f"p.{name}" for name in PROFILE_VALUES)
    ).withColumn("filing_status", F.expr(FILING_CODE))


def join_profile_where_they_are(rows: DataFrame, profile: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """``join_profile`` of latest rows, which lie by worker: they are not moved again.

    With workers too large for one task the five-key join spreads their rows.
    """
    return join_profile_by_worker(rows, profile) if hot is None else join_profile(rows, profile)


def canonical_types(rows: DataFrame, specs: Specs) -> DataFrame:
    """Base tax types become their employee or employer type."""
    pairs = specs.pair_frame(rows.sparkSession).withColumnRenamed("base_type", "tax_type")
    others = [n for n in rows.columns if n != "tax_type"]
    return rows.join(pairs, "tax_type", "left").selectExpr(
        *others,
        "coalesce(CASE WHEN is_employer_tax THEN employer_type ELSE employee_type END, tax_type) AS tax_type",
    )


def slots() -> list[tuple[int, str, str, int, int]]:
    """(order, measure, kind, default width, decimals) of a tax row."""
    return [
        (i, measure, kind, int(width), int(decimals))
        for i, (measure, kind, width, decimals) in enumerate(fixed.table(fixed.TAX_SLOTS))
    ]


_CELL = pa.struct([("code", pa.string()), ("width", pa.int32()), ("mandatory", pa.bool_())])


def cells_by_type(spark: SparkSession, specs: Specs) -> DataFrame:
    """One row per tax type with a cell column per measure.

    Joining this keeps one output row per tax row, where joining the cell list
    would need every row unpivoted into its measures first.
    """
    by_type: dict[str, dict] = {}
    for measure, tax_type, code, width, _, _, mandatory in specs.tax:
        by_type.setdefault(tax_type, {})[measure] = {"code": code, "width": width, "mandatory": mandatory}
    measures = [s[1] for s in slots() if s[2] != "place"]
    schema = pa.schema([("tax_type", pa.string()), *((f"cell_{m}", _CELL) for m in measures)])
    rows = [(tax_type, *(cells.get(m) for m in measures)) for tax_type, cells in by_type.items()]
    return values_frame(spark, schema, rows)


def shown_slots(specs: Specs, columns) -> list[tuple[int, str, str, int, int]]:
    """Slots that some tax type has a code for; the others are never shown."""
    used = {row[0] for row in specs.tax}
    return [s for s in slots() if s[1] in columns and (s[2] == "place" or s[1] in used)]


def slot_text(measure: str, kind: str, width: int, decimals: int) -> str:
    """SQL text of one coded slot; NULL when the slot is not shown."""
    if kind == "place":
        return formats.place_field(slot_code(measure, kind), measure, width)
    code = slot_code(measure, kind)
    if kind == "text":
        return formats.flag_text_field(code, measure, width)
    if kind == "count":
        return formats.count_field(code, measure, width)
    return formats.amount_field(
        code, measure, slot_width(measure, width), f"cell_{measure}.mandatory", decimals
    )


def slot_code(measure: str, kind: str) -> str:
    return f"'{fixed.LIVED_IN_CODE}'" if kind == "place" else f"cell_{measure}.code"


def slot_width(measure: str, width: int) -> str:
    return f"coalesce(cell_{measure}.width, {width})"


def with_cells(rows: DataFrame, specs: Specs) -> DataFrame:
    return rows.join(cells_by_type(rows.sparkSession, specs), "tax_type", "left")


def tax_fields(rows: DataFrame, specs: Specs, keys) -> DataFrame:
    """Long form: one row per tax row and shown field, of canonical ``rows``."""
    coded = []
    for order, measure, kind, width, decimals in shown_slots(specs, rows.columns):
        overflow = (
            formats.amount_overflows(measure, slot_width(measure, width), decimals) if kind == "amount" else "false"
        )
        coded.append(
            f"named_struct('ord', {order}, 'measure', '{measure}', 'code', {slot_code(measure, kind)}, "
            f"'text', {slot_text(measure, kind, width, decimals)}, 'overflow', {overflow})"
        )
    return (
        with_cells(rows, specs)
        .selectExpr(*keys, f"inline(array({', '.join(coded)}))")
        .filter("text IS NOT NULL")
    )


def tax_field_arrays(rows: DataFrame, specs: Specs, keys) -> DataFrame:
    """One row per tax row with its shown fields as an array, in slot order."""
    texts = [slot_text(m, kind, w, d) for _, m, kind, w, d in shown_slots(specs, rows.columns)]
    slotted = with_cells(rows, specs).selectExpr(*keys, f"array({', '.join(texts)}) AS texts")
    # Spark interprets all that is inside a filter of an array. A column that is read twice stays a column, so the texts are compiled.
    return slotted.selectExpr(*keys, "CASE WHEN size(texts) > 0 THEN array_compact(texts) END AS fields")


def default_row_fields(specs: Specs) -> dict[str, list[str]]:
    """Mandatory tax type -> fields of its all-zero default row, in slot order."""
    shown: dict[str, list[str]] = {}
    wanted = {tax_type for _, tax_type in specs.mandatory().values()}
    for _, measure, kind, default_width, _ in slots():
        if kind != "amount" or measure.endswith("_count"):
            continue
        for m, tax_type, code, width, _, _, mandatory in specs.tax:
            if m == measure and tax_type in wanted and mandatory:
                zeros = "0" * ((width or default_width) - 1)
                shown.setdefault(tax_type, []).append(f"{code}+{zeros}")
    return shown
