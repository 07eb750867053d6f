"""Applying skip decisions: long-form anti-joins, packet filters, audit."""

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quartermill.functions.formats import quote
from quartermill.functions.text import jurisdiction_key
from quartermill.operators.queue import queued
from quartermill.session import values_frame
from quartermill.specs.compile import Specs, default_specs
from quartermill.specs.fixed_values import FEDERAL, JURISDICTION_WIDTH

COMPANY = ("branch_code", "company_code")
WORKER_SCOPES = ("SKIP_ENTIRE_EMPLOYEE",)
WORKER_TAX_SCOPES = ("SKIP_ALL_TAX_FOR_EMPLOYEE",)
CODE_SCOPES = ("SKIP_CODE", "SKIP_REPORTING_CODES", "SKIP_NON_REPORTING_CODES")


def of_scope(decisions: DataFrame, *scopes: str) -> DataFrame:
    return decisions.filter(F.col("scope").isin(*scopes))


def _without(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Anti-join.  Staged decisions have a known size, so a small key set is broadcast."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def skip_worker(df: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of workers that are not skipped entirely."""
    return _without(df, of_scope(decisions, *WORKER_SCOPES), ["worker_sk"])


def skip_worker_tax(tax: DataFrame, decisions: DataFrame) -> DataFrame:
    return _without(tax, of_scope(decisions, *WORKER_SCOPES, *WORKER_TAX_SCOPES), ["worker_sk"])


def skip_company(df: DataFrame, decisions: DataFrame) -> DataFrame:
    return _without(df, of_scope(decisions, "SKIP_COMPANY_OUTPUT"), COMPANY)


def skip_company_tax(tax: DataFrame, decisions: DataFrame) -> DataFrame:
    return _without(tax, of_scope(decisions, "SKIP_COMPANY_OUTPUT", "SKIP_COMPANY_TAX_OUTPUT"), COMPANY)


def twin_types(decisions: DataFrame, specs: Specs | None = None) -> DataFrame:
    """Decisions per canonical tax type: a base type stands for its employee and its employer type."""
    pairs = (specs or default_specs()).pair_frame(decisions.sparkSession).selectExpr(
        "base_type AS tax_type", "array(employee_type, employer_type) AS twins"
    )
    others = [n for n in decisions.columns if n != "tax_type"]
    return decisions.join(pairs, "tax_type", "left").selectExpr(*others, "explode(coalesce(twins, array(tax_type))) AS tax_type")


def skip_jurisdiction(tax: DataFrame, decisions: DataFrame) -> DataFrame:
    """Tax rows (of canonical types) outside the skipped jurisdictions.

    A decision without a tax type covers all types of its jurisdiction, one
    without a worker all workers of its company.  The decisions are split by the
    keys they set, so each part is a plain equality anti-join.
    """
    wanted = twin_types(of_scope(decisions, "SKIP_TAX_JURISDICTION"))
    for worker_set in (True, False):
        for type_set in (True, False):
            part = wanted.filter(F.col("worker_sk").isNotNull() == worker_set).filter(
                F.col("tax_type").isNotNull() == type_set
            )
            on = ["worker_sk"] if worker_set else list(COMPANY)
            tax = _without(tax, part, [*on, "jurisdiction", *(["tax_type"] if type_set else [])])
    return tax


def reporting_groups(spark, reporting: list[str], non_reporting: list[str]) -> DataFrame:
    rows = [(c, "SKIP_REPORTING_CODES") for c in reporting] + [(c, "SKIP_NON_REPORTING_CODES") for c in non_reporting]
    return values_frame(spark, pa.schema([("code", pa.string()), ("scope", pa.string())]), rows)


def code_targets(decisions: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Decisions per code: listed codes, and the codes of a reporting group."""
    if "side" not in decisions.columns:
        decisions = decisions.withColumn("side", F.lit("BOTH"))
    keys = ["company_error_sk", "rule_id", "scope", *COMPANY, "worker_sk", "jurisdiction", "side"]
    listed = of_scope(decisions, "SKIP_CODE").select(*keys, F.explode("codes").alias("code"))
    if groups is None:
        return listed
    grouped = of_scope(decisions, "SKIP_REPORTING_CODES", "SKIP_NON_REPORTING_CODES").join(groups, "scope")
    return listed.unionByName(grouped.select(*keys, "code"))


def skip_codes(fields: DataFrame, decisions: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Long-form fields without the skipped codes; NULL jurisdiction means everywhere."""
    targets = code_targets(decisions, groups)
    for worker_set in (True, False):
        for juris_set in (True, False):
            part = targets.filter(F.col("worker_sk").isNotNull() == worker_set).filter(
                F.col("jurisdiction").isNotNull() == juris_set
            )
            on = ["worker_sk"] if worker_set else list(COMPANY)
            fields = _without(fields, part, [*on, "code", *(["jurisdiction"] if juris_set else [])])
    return fields


def merge(decisions: DataFrame) -> DataFrame:
    """Each decision with the broadest one that covers all it removes.

    Company output covers everything of the company, a whole worker everything
    of the worker.  The tax-only scopes cover tax decisions alone: worker tax,
    jurisdictions, and codes inside a jurisdiction.  A jurisdiction skipped for
    all tax types covers the codes inside it.  A code without a jurisdiction may
    be a worker field, which only the two output scopes cover.
    """
    def marked(where: str, keys: list[str], name: str) -> DataFrame:
        return decisions.filter(where).select(*keys).distinct().withColumn(name, F.lit(True))

    company, all_types = list(COMPANY), "scope = 'SKIP_TAX_JURISDICTION' AND tax_type IS NULL"
    marks = (
        (marked("scope = 'SKIP_COMPANY_OUTPUT'", company, "by_output"), company),
        (marked("scope = 'SKIP_COMPANY_TAX_OUTPUT'", company, "by_tax"), company),
        (marked("scope = 'SKIP_ENTIRE_EMPLOYEE'", ["worker_sk"], "by_worker"), ["worker_sk"]),
        (marked("scope = 'SKIP_ALL_TAX_FOR_EMPLOYEE'", ["worker_sk"], "by_worker_tax"), ["worker_sk"]),
        (marked(f"{all_types} AND worker_sk IS NULL", [*company, "jurisdiction"], "by_place"), [*company, "jurisdiction"]),
        (marked(f"{all_types} AND worker_sk IS NOT NULL", ["worker_sk", "jurisdiction"], "by_own_place"), ["worker_sk", "jurisdiction"]),
    )
    out = decisions
    for mark, keys in marks:
        out = out.join(mark, keys, "left")
    code = f"scope IN ({', '.join(map(quote, CODE_SCOPES))})"
    tax_only = f"(scope IN ('SKIP_ALL_TAX_FOR_EMPLOYEE', 'SKIP_TAX_JURISDICTION') OR {code} AND jurisdiction IS NOT NULL)"
    return out.selectExpr(
        "*",
        f"""CASE WHEN scope = 'NO_SKIP' THEN scope_rank ELSE least(scope_rank,
            CASE WHEN by_output THEN 1 END, CASE WHEN by_tax AND {tax_only} THEN 2 END,
            CASE WHEN by_worker AND scope_rank > 3 THEN 3 END, CASE WHEN by_worker_tax AND {tax_only} THEN 4 END,
            CASE WHEN (by_place OR by_own_place) AND {code} THEN 5 END) END AS effective_rank""",
    ).selectExpr(
        "company_error_sk", "rule_id", "scope", *COMPANY, "worker_sk", "scope_rank", "effective_rank",
        "effective_rank < scope_rank AS dominated",
    )


# --- packets -----------------------------------------------------------------


@dataclass(frozen=True)
class PacketDecisions:
    """Decisions folded per worker and per company, for the packet job."""

    by_worker: DataFrame
    by_company: DataFrame

    COLUMNS = ("skip_tax", "juris_skips", "code_skips")

    @staticmethod
    def fold(decisions: DataFrame, groups: DataFrame | None = None) -> "PacketDecisions":
        """Sets are collected distinct, so their size is bounded by the codes and jurisdictions."""
        targets = code_targets(decisions, groups).selectExpr(
            *COMPANY, "worker_sk",
            f"named_struct('juris', CASE WHEN jurisdiction IS NOT NULL THEN {jurisdiction_key('jurisdiction')} END, 'code', code, 'side', side) AS code_skip",
        )
        skipping = twin_types(decisions.filter("scope <> 'NO_SKIP'")).selectExpr(
            *COMPANY, "worker_sk", "scope",
            f"CASE WHEN scope = 'SKIP_TAX_JURISDICTION' THEN named_struct('juris', {jurisdiction_key('jurisdiction')}, 'tax_type', tax_type) END AS juris_skip",
        )
        rows = skipping.unionByName(targets, allowMissingColumns=True)

        def folded(part: DataFrame, keys, output: str, tax: str) -> DataFrame:
            return part.groupBy(*keys).agg(
                F.expr(f"coalesce(max(scope IN ({output})), false) AS output_{keys[-1]}"),
                F.expr(f"coalesce(max(scope IN ({tax})), false) AS tax_{keys[-1]}"),
                F.collect_set("juris_skip").alias(f"juris_{keys[-1]}"),
                F.collect_set("code_skip").alias(f"codes_{keys[-1]}"),
            )

        workers = folded(
            rows.filter("worker_sk IS NOT NULL"), ["worker_sk"], "'SKIP_ENTIRE_EMPLOYEE'", "'SKIP_ALL_TAX_FOR_EMPLOYEE'"
        )
        # Narrow decisions about one worker must not reach the whole company.
        whole = rows.filter(
            "worker_sk IS NULL OR scope IN ('SKIP_COMPANY_OUTPUT', 'SKIP_COMPANY_TAX_OUTPUT')"
        )
        companies = folded(whole, list(COMPANY), "'SKIP_COMPANY_OUTPUT'", "'SKIP_COMPANY_TAX_OUTPUT'")
        return PacketDecisions(workers, companies)

    def attach(self, arrays: DataFrame) -> DataFrame:
        """Drop skipped workers and companies; keep the narrower decisions as columns."""
        joined = arrays.join(self.by_company, list(COMPANY), "left").join(
            self.by_worker, "worker_sk", "left"
        )
        skipped = "coalesce(output_company_code, false) OR coalesce(output_worker_sk, false)"
        both = "concat(coalesce({0}_company_code, array()), coalesce({0}_worker_sk, array())) AS {0}_skips"
        return joined.filter(f"NOT ({skipped})").selectExpr(
            *arrays.columns,
            "coalesce(tax_company_code, false) OR coalesce(tax_worker_sk, false) AS skip_tax",
            both.format("juris"),
            both.format("codes").replace("codes_skips", "code_skips"),
        )

    def keeps_row(self, juris: str = "juris", tax_type: str = "tax_type") -> str:
        """Condition: no decision removes this tax row."""
        return (
            f"NOT exists(juris_skips, k -> k.juris = {juris} AND coalesce(k.tax_type = {tax_type}, true))"
        )

    def keeps_codes(self, fields: str, juris: str, tax_type: str = "tax_type") -> str:
        """Fields of a jurisdiction that no decision removes; worker fields that ride on it have no tax type."""
        return (
            f"filter({fields}, t -> NOT exists(code_skips, k -> k.code = left(t, 2) AND coalesce(k.juris = {juris}, true) "
            f"AND k.side <> CASE WHEN {tax_type} = '' THEN 'TAX' ELSE 'WORKER' END))"
        )

    def kept_rows(self, rows: str) -> str:
        return f"filter({rows}, r -> {self.keeps_row('r.juris', 'r.tax_type')})"

    def blocks_default(self, tax_type: str) -> str:
        federal = quote(FEDERAL.ljust(JURISDICTION_WIDTH))
        return (
            f"exists(juris_skips, k -> k.juris = {federal} AND coalesce(k.tax_type = {quote(tax_type)}, true))"
        )

    def drop_tax(self, steps: DataFrame) -> DataFrame:
        return steps.withColumn("taxed", F.expr("CASE WHEN skip_tax THEN filter(taxed, r -> false) ELSE taxed END"))

    def kept_fields(self, fields: str) -> str:
        """Worker fields outside any jurisdiction."""
        return f"filter({fields}, t -> NOT exists(code_skips, k -> k.juris IS NULL AND k.code = left(t, 2) AND k.side <> 'TAX'))"

    def kept_codes(self, rows: str) -> str:
        kept = self.keeps_codes("r.fields", "r.juris", "r.tax_type")
        left = f"transform({rows}, r -> named_struct('juris', r.juris, 'fields', {kept}))"
        return (
            f"CASE WHEN size(code_skips) = 0 THEN transform({rows}, r -> named_struct('juris', r.juris, 'text', r.text, 'fields', r.fields)) "
            f"ELSE transform({left}, r -> named_struct('juris', r.juris, 'text', array_join(r.fields, ''), 'fields', r.fields)) END"
        )


# --- audit -------------------------------------------------------------------


_KEY_PARTS = {
    "branch": "STRING", "company": "STRING", "worker": "BIGINT", "place": "STRING", "tax": "STRING", "code": "STRING", "out": "BOOLEAN",
}


def _key(kind: str, **set_: str) -> str:
    """Struct key of a target; parts that are not set are NULL."""
    values = ", ".join(f"'{n}', CAST({set_.get(n, 'NULL')} AS {t})" for n, t in _KEY_PARTS.items())
    return f"named_struct('kind', '{kind}', {values})"


_C = {"branch": "branch_code", "company": "company_code"}
_W = {"worker": "worker_sk"}
_OUT = {"out": "true"}
_P, _T, _K = {"place": "jurisdiction"}, {"tax": "tax_type"}, {"code": "code"}
# What a decision removes: rows of tax output, employee lines, or single fields.
_DECISION_KEYS = f"""CASE scope
    WHEN 'SKIP_COMPANY_OUTPUT' THEN array({_key('row', **_C)}, {_key('row', **_C, **_OUT)})
    WHEN 'SKIP_COMPANY_TAX_OUTPUT' THEN array({_key('row', **_C)})
    WHEN 'SKIP_ENTIRE_EMPLOYEE' THEN array({_key('row', **_W)}, {_key('row', **_W, **_OUT)})
    WHEN 'SKIP_ALL_TAX_FOR_EMPLOYEE' THEN array({_key('row', **_W)})
    WHEN 'SKIP_TAX_JURISDICTION' THEN array(CASE WHEN worker_sk IS NULL THEN {_key('row', **_C, **_P, **_T)}
        ELSE {_key('row', **_W, **_P, **_T)} END) END"""
# Target keys that an item counts for: those of its company, those of its worker.
_ROW_KEYS = (
    f"array({_key('row', **_C)}, {_key('row', **_C, **_P, **_T)}, {_key('row', **_C, **_P)})",
    f"array({_key('row', **_W)}, {_key('row', **_W, **_P, **_T)}, {_key('row', **_W, **_P)})",
)
_LINE_KEYS = f"array({_key('row', **_C, **_OUT)})", f"array({_key('row', **_W, **_OUT)})"
_CODE_KEY = f"CASE WHEN worker_sk IS NULL THEN {_key('field', **_C, **_K, **_P)} ELSE {_key('field', **_W, **_K, **_P)} END"
_FIELD_KEYS = (
    f"array({_key('field', **_C, **_K)}, {_key('field', **_C, **_K, **_P)})",
    f"array({_key('field', **_W, **_K)}, {_key('field', **_W, **_K, **_P)})",
)
_ENTITY = "CASE WHEN {0} THEN concat_ws('|', 'W', worker_sk) ELSE concat_ws('|', 'C', branch_code, company_code) END"
_ROW_TEXT = _ENTITY.format("scope NOT IN ('SKIP_COMPANY_OUTPUT', 'SKIP_COMPANY_TAX_OUTPUT') AND worker_sk IS NOT NULL")
_ROW_TEXT = f"concat_ws('|', {_ROW_TEXT}, CASE WHEN scope = 'SKIP_TAX_JURISDICTION' THEN concat_ws('|', 'J', jurisdiction, tax_type) END)"
_CODE_TEXT = f"concat_ws('|', {_ENTITY.format('worker_sk IS NOT NULL')}, 'K', code, jurisdiction)"


def audit(
    decisions: DataFrame,
    tax_rows: DataFrame,
    fields: DataFrame,
    worker_rows: DataFrame,
    worker_fields: DataFrame,
    groups: DataFrame | None = None,
) -> DataFrame:
    """What each decision removes on its own, with the company's tax rows before and after.

    Rows are tax rows, and for the two output scopes also the workers' employee
    lines (``worker_rows``: one row per worker).  Fields are tax fields and, for
    codes without a jurisdiction, the workers' own fields.  Output items are
    counted per target key first (combined before the shuffle), so a decision
    meets a few count rows and never a group of items: companies have few
    different items, and of the workers only those of a decision are counted.  ``target`` is for
    reading; the join uses struct keys.
    """
    named_workers = decisions.where("worker_sk IS NOT NULL").select("worker_sk").distinct()

    def counted(items: DataFrame, per: list[str], keys: tuple[str, str]) -> DataFrame:
        # Equal items are merged before each is expanded into its target keys; only workers of a decision are counted one by one.
        whole = items.groupBy(*COMPANY, *per).agg(F.count("*").alias("n"))
        single = items.join(named_workers, "worker_sk", "left_semi").groupBy("worker_sk", *per).agg(F.count("*").alias("n"))
        parts = [df.select(F.explode(F.array_distinct(F.expr(k))).alias("key"), "n") for df, k in zip((whole, single), keys)]
        return parts[0].unionByName(parts[1])

    worker_codes = worker_fields.withColumn("jurisdiction", F.lit(None).cast("string"))
    counts = (
        counted(tax_rows, ["jurisdiction", "tax_type"], _ROW_KEYS)
        .unionByName(counted(worker_rows, [], _LINE_KEYS))
        .unionByName(counted(fields, ["jurisdiction", "code"], _FIELD_KEYS))
        .unionByName(counted(worker_codes, ["jurisdiction", "code"], _FIELD_KEYS))
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )
    totals = tax_rows.groupBy(*COMPANY).agg(F.count("*").alias("rows_before"))
    # A worker-side scope without a worker, and a missing company, remove nothing.
    found = decisions.filter(~F.col("scope").isin("NO_SKIP", *CODE_SCOPES))
    columns = ["company_error_sk", "rule_id", "scope", *COMPANY, "worker_sk"]
    texts = found.select(*columns, "jurisdiction", "tax_type", F.expr(_ROW_TEXT).alias("target"))
    by_row = twin_types(texts).select(*columns, "target", F.explode(F.expr(_DECISION_KEYS)).alias("key"))
    by_code = code_targets(decisions, groups).select(*columns, F.expr(_CODE_TEXT).alias("target"), F.expr(_CODE_KEY).alias("key"))
    named = F.expr("CASE WHEN coalesce(key.branch, key.company, CAST(key.worker AS STRING)) IS NOT NULL THEN key END")
    wanted = by_row.unionByName(by_code).withColumn("key", named)
    tax = "key.kind = 'row' AND key.out IS NULL"
    return (
        wanted.join(counts, "key", "left")
        .groupBy(*columns, "target")
        .agg(F.sum("n").alias("removed"), F.expr(f"sum(CASE WHEN {tax} THEN n END) AS tax_removed"))
        .join(totals, list(COMPANY), "left")
        .selectExpr(
            *columns, "target", "coalesce(removed, 0L) AS removed", "coalesce(rows_before, 0L) AS rows_before",
            "coalesce(rows_before, 0L) - coalesce(tax_removed, 0L) AS rows_after",
        )
    )


def error_write_status(errors: DataFrame, audit_rows: DataFrame) -> DataFrame:
    """New write status: SKIPPED with effect, WRITTEN when seen without effect, else unchanged."""
    effect = audit_rows.groupBy("company_error_sk").agg(F.sum("removed").alias("removed"))
    return errors.join(effect, "company_error_sk", "left").selectExpr(
        "company_error_sk", "error_code", "write_status AS old_status",
        """CASE WHEN NOT (resolution_status = 'Open' AND write_status = 'PENDING') THEN write_status
                WHEN coalesce(removed, 0L) > 0 THEN 'SKIPPED' ELSE 'WRITTEN' END AS write_status""",
    )


def seen_units(changes: DataFrame, queue: DataFrame, organization: DataFrame) -> DataFrame:
    """Organization units (``organization_unit_sk``) of which a file of this run ended GENERATED or SKIPPED.

    ``changes``: the queue after the run; only rows that were queued before it
    belong to the run.
    """
    run = queued(queue).select("batch_id").distinct()
    ended = changes.where(F.col("status").isin("GENERATED", "SKIPPED")).join(run, "batch_id", "left_semi")
    sites = ended.select("site_id").distinct()
    return organization.join(sites, "site_id", "left_semi").select("organization_unit_sk").distinct()


def write_status_after_run(errors: DataFrame, audit_rows: DataFrame, units: DataFrame) -> DataFrame:
    """``error_write_status`` where the run reached the error: an error of no unit of ``units`` stays as it was.

    A file that failed, or was not queued, has neither shown its company's
    errors nor skipped anything for them, so the next run takes them up again.
    """
    seen = units.select("organization_unit_sk", F.lit(True).alias("seen"))
    status = error_write_status(errors, audit_rows)
    reached = errors.join(seen, "organization_unit_sk", "left").select("company_error_sk", F.coalesce("seen", F.lit(False)).alias("seen"))
    return status.join(reached, "company_error_sk").select(
        "company_error_sk", "error_code", "old_status", F.when(F.col("seen"), F.col("write_status")).otherwise(F.col("old_status")).alias("write_status"), "seen"
    )
