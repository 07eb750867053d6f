"""Audit of skip decisions in lines: what each one, applied alone, takes out of the files of its company.

Lines are packed once without any decision. Then only workers that a narrow
decision touches are packed again with it; decisions of equal effect share that
work. The broad scopes need no second packing: they remove all lines, or all
tax lines, of a company or a worker.

A worker's rows of a period are packed in one task here, also those of workers
whom the filing job itself splits over several.
"""

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from quartermill.functions import packing
from quartermill.functions.text import jurisdiction_key
from quartermill.operators import queue as queue_ops, workers
from quartermill.operators.sizing import local_if_small
from quartermill.operators.skips import CODE_SCOPES, COMPANY, PacketDecisions, code_targets, of_scope, twin_types
from quartermill.plans.worker_lines import (
    ARRAY_KEYS, Inputs, coded_tax_rows, default_tax_rows, in_periods, level_rows, period_tax_rows, site_workers, tax_sets,
)
from quartermill.session import stage
from quartermill.specs.compile import Specs, default_specs
from quartermill.specs.fixed_values import FEDERAL, JURISDICTION_WIDTH

FILE = ("site_id", "year", "quarter", *COMPANY)
OUTPUT, TAX = ("SKIP_COMPANY_OUTPUT", "SKIP_ENTIRE_EMPLOYEE"), ("SKIP_COMPANY_TAX_OUTPUT", "SKIP_ALL_TAX_FOR_EMPLOYEE")
DECISION = ("company_error_sk", "rule_id")


def field_rows(inputs: Inputs, specs: Specs) -> DataFrame:
    """One row per worker and queued period with all that its lines are packed from."""
    periods = local_if_small(queue_ops.site_periods(inputs.queue))
    inputs = replace(inputs, snapshot=in_periods(inputs.snapshot, periods))
    coded = coded_tax_rows(period_tax_rows(inputs), specs)
    sets = tax_sets(coded)
    people = workers.worker_profile(site_workers(inputs, periods.select("site_id").distinct()), inputs.address)
    arrays = workers.level_arrays(people, specs, ARRAY_KEYS)
    texts = [F.array_join(f"{level}_fields", "").alias(f"{level}_text") for level in "fsl"]
    # Employee lines are the same in every period.
    arrays = arrays.select("*", *texts, F.expr(f"{packing.count_worker_lines('ee_fields')} AS own"))
    rows = sets.join(arrays, "worker_sk").join(periods, ["site_id", "year", "quarter"], "left_semi")
    return rows


def counted(rows: DataFrame, specs: Specs, decisions: PacketDecisions | None = None) -> DataFrame:
    """``rows`` with the numbers of their employee lines and tax lines (``own``, ``tax``)."""
    others = [c for c in rows.columns if c not in ("tax_set", "ee_fields", "own")]
    steps = rows if decisions else rows.withColumn("kept", F.col("tax_set"))
    if decisions:
        steps = rows.withColumn("kept", F.expr(decisions.kept_rows("tax_set")))
    blocked = decisions.blocks_default if decisions else None
    steps = steps.withColumn("taxed", F.expr(f"concat(kept, {default_tax_rows('kept', specs, blocked)})"))
    ordered = f"sort_array(concat({level_rows('taxed')}, taxed))"
    steps = steps.withColumn("ordered", F.expr(decisions.kept_codes(ordered) if decisions else ordered))
    own = "own"
    if decisions:
        cut = "exists(code_skips, k -> k.juris IS NULL AND k.side <> 'TAX')"
        own = f"CASE WHEN {cut} THEN {packing.count_worker_lines(decisions.kept_fields('ee_fields'))} ELSE own END AS own"
    return steps.selectExpr(*others, own, f"{packing.count_rows('ordered')} AS tax")


def effects(decisions: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Narrow decisions with what they skip (``juris_skips``, ``code_skips``) and a key of their effect."""
    codes = code_targets(decisions, groups).selectExpr(
        *DECISION, *COMPANY, "worker_sk",
        f"named_struct('juris', CASE WHEN jurisdiction IS NOT NULL THEN {jurisdiction_key('jurisdiction')} END, 'code', code, 'side', side) AS code_skip",
    )
    places = twin_types(of_scope(decisions, "SKIP_TAX_JURISDICTION")).selectExpr(
        *DECISION, *COMPANY, "worker_sk", f"named_struct('juris', {jurisdiction_key('jurisdiction')}, 'tax_type', tax_type) AS juris_skip"
    )
    folded = places.unionByName(codes, allowMissingColumns=True).groupBy(*DECISION, *COMPANY, "worker_sk").agg(
        F.array_sort(F.collect_set("juris_skip")).alias("juris_skips"), F.array_sort(F.collect_set("code_skip")).alias("code_skips")
    )
    # A decision about a worker is the same whichever company raised it.
    company = [F.when(F.col("worker_sk").isNull(), F.col(c)).alias(c) for c in COMPANY]
    folded = folded.select(*DECISION, *company, "worker_sk", "juris_skips", "code_skips")
    return folded.withColumn("effect", F.md5(F.to_json(F.struct(*COMPANY, "worker_sk", "juris_skips", "code_skips"))))


def audit(
    inputs: Inputs, decisions: DataFrame, active: DataFrame, specs: Specs | None = None, groups: DataFrame | None = None
) -> DataFrame:
    """Rows for every skipping decision and every queued file its company, or its worker, has lines in.

    ``active``: the errors with their catalog facts. Counts are of the
    company's lines in that file, without any decision and with this one
    alone. A decision that no queued file knows has one row without a file,
    with zeros.
    """
    specs = specs or default_specs()
    rows = stage(field_rows(inputs, specs), "audit-fields")
    keys = [*FILE, "worker_sk"]
    base = stage(counted(rows, specs).select(*keys, "own", "tax"), "audit-lines")
    totals = base.groupBy(*FILE).agg(F.sum("own").alias("own"), F.sum("tax").alias("tax"))
    found = stage(effects(decisions, groups), "audit-effects")
    variants = found.select("effect", *COMPANY, "worker_sk", "juris_skips", "code_skips").distinct()
    whole = variants.where("worker_sk IS NULL").drop("worker_sk")
    single = variants.where("worker_sk IS NOT NULL").drop(*COMPANY)
    pairs = rows.join(whole, list(COMPANY)).unionByName(rows.join(single, "worker_sk")).withColumn("skip_tax", F.lit(False))
    rules = PacketDecisions(None, None)
    federal = FEDERAL.ljust(JURISDICTION_WIDTH)
    touched = f"size(code_skips) > 0 OR exists(juris_skips, k -> k.juris = '{federal}') OR size({rules.kept_rows('tax_set')}) < size(tax_set)"
    again = counted(pairs.where(touched), specs, rules).select("effect", *keys, F.col("own").alias("own_left"), F.col("tax").alias("tax_left"))
    less = again.join(base, keys).groupBy("effect", *FILE).agg(
        F.sum(F.col("own") - F.col("own_left")).alias("own_less"), F.sum(F.col("tax") - F.col("tax_left")).alias("tax_less")
    )
    skipping = decisions.where(F.col("scope") != "NO_SKIP").select(
        *DECISION, "error_code", "resolved_category", "scope", "branch_code", "company_code", "worker_sk", "jurisdiction", "tax_type"
    )
    # The files of a decision: those of its worker, if it is about one, else those of its company.
    by_worker = F.col("worker_sk").isNotNull() & ~F.col("scope").isin("SKIP_COMPANY_OUTPUT", "SKIP_COMPANY_TAX_OUTPUT")
    about = skipping.select(*DECISION, "scope", *COMPANY, F.when(by_worker, F.col("worker_sk")).alias("worker_sk"))
    # A scope of a worker without a worker removes nothing.
    about = about.where("worker_sk IS NOT NULL OR scope NOT IN ('SKIP_ENTIRE_EMPLOYEE', 'SKIP_ALL_TAX_FOR_EMPLOYEE')")
    drop_own, drop_tax = F.col("scope").isin(*OUTPUT), F.col("scope").isin(*OUTPUT, *TAX)


    def cut(side: DataFrame) -> DataFrame:
        gone = [F.when(flag, F.col(n)).otherwise(0).alias(f"{n}_all") for n, flag in (("own", drop_own), ("tax", drop_tax))]
        return side.select(*DECISION, *FILE, *gone)

    companies = cut(about.where("worker_sk IS NULL").select(*DECISION, "scope", *COMPANY).join(totals, list(COMPANY)))
    people = cut(about.where("worker_sk IS NOT NULL").select(*DECISION, "scope", "worker_sk").join(base, "worker_sk"))
    files = companies.unionByName(people)
    files = files.join(found.select(*DECISION, "effect"), list(DECISION), "left").join(less, ["effect", *FILE], "left").join(totals, list(FILE))
    after = {n: F.col(n) - F.col(f"{n}_all") - F.coalesce(f"{n}_less", F.lit(0)) for n in ("own", "tax")}
    files = files.select(
        *DECISION, "site_id", "year", "quarter", F.col("branch_code").alias("file_branch"), F.col("company_code").alias("file_company"),
        F.col("own").alias("worker_lines_before"), after["own"].alias("worker_lines_after"),
        F.col("tax").alias("tax_lines_before"), after["tax"].alias("tax_lines_after"),
    )
    facts = active.select("company_error_sk", "category", "impacts_deposit", "impacts_filing")
    out = skipping.join(facts, "company_error_sk", "left").join(files, list(DECISION), "left")
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("worker_lines_before", "worker_lines_after", "tax_lines_before", "tax_lines_after")]
    return out.select(
        *DECISION, "error_code", "category", "resolved_category", "impacts_deposit", "impacts_filing", "scope", "worker_sk", "jurisdiction", "tax_type",
        "site_id", "year", "quarter", F.coalesce("file_branch", "branch_code").alias("branch_code"), F.coalesce("file_company", "company_code").alias("company_code"), *counts,
    )
