"""Registered queries: every operator and job over the sample views."""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from quartermill import schemas
from quartermill.functions import formats, packing
from quartermill.functions.text import (
    impact_flag, jurisdiction_class, jurisdiction_key, jurisdiction_order, normalize_category,
)
from quartermill.operators import assembly, errors, groups, history, mandatory, quality, quarantine, queue, skips, taxes, workers
from quartermill.operators.sizing import hot_workers
from quartermill.plans import line_audit, site_files, worker_lines
from quartermill.session import compiled, shared_folder, stage
from quartermill.sources import feed, sample_views, text_files, warehouse
from quartermill.specs import compile as spec_jobs

import uuid

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TIME = "2026-01-15 08:30:00"
AS_OF = "2026-01-15"
PERIOD = ("worker_sk", "year", "quarter")
TAX_ROW = ("worker_sk", "year", "quarter", "jurisdiction", "tax_type", "is_employer_tax", "payroll_run_sk")
REPORTING = ["EJ", "EK", "MV", "NT"]
NON_REPORTING = ["DF", "DH", "DK", "X1", "G6"]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = compiled(run)
    return run


# --- inputs ------------------------------------------------------------------


def _in(spark, sf) -> worker_lines.Inputs:
    return sample_views.inputs(spark, sf)


def _load(spark, sf, view, schema) -> DataFrame:
    return schemas.conform(sample_views.view(spark, sf, view), schema, view, blank_as_null=view != "fx_address")


def _worker(spark, sf):
    return _load(spark, sf, "fx_worker", schemas.WORKER)


def _snapshot(spark, sf):
    return _load(spark, sf, "fx_snapshot", schemas.SNAPSHOT)


def _profile(spark, sf):
    return _load(spark, sf, "fx_profile", schemas.PROFILE)


def _org(spark, sf):
    return _load(spark, sf, "fx_org", schemas.ORGANIZATION)


def _queue(spark, sf):
    return _load(spark, sf, "fx_queue", schemas.QUEUE)


def _errors(spark, sf):
    return _load(spark, sf, "fx_error", schemas.ERRORS)


def _profiled(spark, sf) -> DataFrame:
    return workers.worker_profile(_worker(spark, sf), _load(spark, sf, "fx_address", schemas.ADDRESS))


def _amounts(spark, sf) -> DataFrame:
    snapshot = _snapshot(spark, sf)
    return taxes.with_amounts(taxes.latest_run(snapshot, hot_workers(snapshot)))


def _joined(spark, sf) -> DataFrame:
    snapshot, profile = _snapshot(spark, sf), _profile(spark, sf)
    hot = hot_workers(snapshot, profile)
    return taxes.join_profile_where_they_are(taxes.with_amounts(taxes.latest_run(snapshot, hot)), profile, hot)


def _canonical(spark, sf) -> DataFrame:
    return taxes.canonical_types(_joined(spark, sf), spec_jobs.default_specs())


def _fields(spark, sf, *keys) -> DataFrame:
    return taxes.tax_fields(_canonical(spark, sf), spec_jobs.default_specs(), [*TAX_ROW, *keys])


def _decisions(spark, sf, scope: dict | None = None) -> DataFrame:
    """Sample decisions; ``scope`` overrides what a resolved category skips."""
    rules = tuple(
        (i, category, (scope or {}).get(category, s), codes, start, end)
        for i, category, s, codes, start, end in errors.DEFAULT_RULES
    )
    book = errors.RuleBook(errors.DEFAULT_MAPPINGS, rules)
    decisions = errors.decide(_errors(spark, sf), errors.default_catalog(spark), _org(spark, sf), AS_OF, book)
    # Several key sets are read from the decisions, so they are written once.
    return stage(decisions, "decisions")


def _groups(spark) -> DataFrame:
    return skips.reporting_groups(spark, REPORTING, NON_REPORTING)


# --- scans, queue, specifications ---------------------------------------------


@query
def scan_worker(spark, sf):
    return _worker(spark, sf).select("worker_sk", "branch_code", "company_code", "family_name", "given_name", "ssn", "hire_date")


@query
def table_count(spark, sf):
    names = ("fx_worker", "fx_address", "fx_snapshot", "fx_profile", "fx_queue", "fx_error")
    counts = [warehouse.table_count(sample_views.view(spark, sf, name), name) for name in names]
    total = counts[0]
    for other in counts[1:]:
        total = total.unionByName(other)
    return total


@query
def queued_work(spark, sf):
    return queue.queued(_queue(spark, sf))


@query
def site_companies(spark, sf):
    return queue.site_companies(_org(spark, sf), _queue(spark, sf))


@query
def org_lookup(spark, sf):
    return queue.lookup_company(_org(spark, sf), "C007")


@query
def status_normalize(spark, sf):
    raw = sample_views.view(spark, sf, "fx_queue").selectExpr("batch_id", "raw_status AS status")
    return queue.normalize_status(raw)


@query
def output_names(spark, sf):
    return queue.output_names(queue.site_periods(_queue(spark, sf)), RUN_TIME)


@query
def field_spec_scan(spark, sf):
    return spec_jobs.field_rows(sample_views.view(spark, sf, "fx_field_raw"))


@query
def field_level_scan(spark, sf):
    return spec_jobs.level_rows(sample_views.view(spark, sf, "fx_level_raw"))


@query
def compile_field_spec(spark, sf):
    return spec_jobs.compile_field_spec(
        sample_views.view(spark, sf, "fx_field_raw"), sample_views.view(spark, sf, "fx_level_raw")
    )


@query
def tax_spec_from_feed(spark, sf):
    items = feed.parse_feed(sample_views.view(spark, sf, "fx_feed_json"))
    return spec_jobs.tax_spec_from_feed(items, compile_field_spec(spark, sf))


@query
def tax_pairs(spark, sf):
    return spec_jobs.tax_pairs(feed.parse_feed(sample_views.view(spark, sf, "fx_feed_json")))


def _checked_feed(spark, sf):
    return feed.checked(sample_views.view(spark, sf, "fx_feed_damaged"))


@query
def feed_rejects(spark, sf):
    return feed.rejects(_checked_feed(spark, sf))


@query
def feed_accepted(spark, sf):
    return feed.accepted(_checked_feed(spark, sf))


@query
def default_values(spark, sf):
    return spec_jobs.default_values(compile_field_spec(spark, sf))


@query
def default_specs(spark, sf):
    """The built-in field rows, with the number of workers that show each field."""
    specs = spec_jobs.default_specs()
    shown = workers.worker_fields(_profiled(spark, sf), specs).groupBy("ord").agg(F.count("*").alias("workers"))
    return specs.field_frame(spark).join(shown, "ord", "left").selectExpr(
        "ord", "source_column", "code", "format", "width", "level", "coalesce(workers, 0L) AS workers"
    )


# --- workers -------------------------------------------------------------------


@query
def address_pivot(spark, sf):
    return workers.address_pivot(_load(spark, sf, "fx_address", schemas.ADDRESS))


@query
def worker_flags(spark, sf):
    return _profiled(spark, sf).select("worker_sk", *workers.FLAGS)


@query
def worker_profile(spark, sf):
    drop = list(workers.FLAGS)
    return _profiled(spark, sf).drop(*drop)


@query
def workers_in_period(spark, sf):
    return workers.workers_in_period(_worker(spark, sf), _snapshot(spark, sf))


@query
def worker_counts(spark, sf):
    return workers.worker_counts(_worker(spark, sf), _snapshot(spark, sf))


@query
def worker_fields(spark, sf):
    return workers.worker_fields(_profiled(spark, sf), spec_jobs.default_specs())


@query
def level_fields(spark, sf):
    arrays = workers.level_arrays(_profiled(spark, sf), spec_jobs.default_specs(), ["worker_sk"])
    levels = ", ".join(f"named_struct('level', '{lv}', 'fields', {lv.lower()}_fields)" for lv in ("F", "S", "L"))
    return arrays.selectExpr("worker_sk", f"inline(array({levels}))").select(
        "worker_sk", "level", F.posexplode("fields").alias("seq", "text")
    )


@query
def fmt_text(spark, sf):
    return _worker(spark, sf).selectExpr(
        "worker_sk",
        f"{formats.text_field(formats.quote('Z3'), 'job_title', 12)} AS cut_right",
        f"{formats.text_field(formats.quote('V9'), 'employee_id', 8, 'left')} AS padded_left",
        f"{formats.text_field(formats.quote('CU'), 'family_name', None)} AS unbounded",
    )


@query
def fmt_ssn(spark, sf):
    return _worker(spark, sf).selectExpr("worker_sk", f"{formats.identity_field(formats.quote('DD'), 'ssn')} AS text")


@query
def fmt_overflow(spark, sf):
    return _worker(spark, sf).selectExpr(
        "worker_sk",
        f"{formats.overflow_field(formats.quote('CS'), 'upper(given_name)', 12, 'A1', 12)} AS given",
        f"{formats.overflow_field(formats.quote('CU'), 'upper(family_name)', 14, 'A2', 14)} AS family",
    )


@query
def fmt_number(spark, sf):
    return _worker(spark, sf).selectExpr(
        "worker_sk",
        f"{formats.number_field(formats.quote('N1'), '(worker_sk - 700)', 8, True)} AS signed_text",
        f"{formats.number_field(formats.quote('N2'), 'worker_sk', 6, False)} AS unsigned_text",
    )


@query
def fmt_decimal(spark, sf):
    return _snapshot(spark, sf).selectExpr(
        "worker_sk", "payroll_run_sk", "qtd_amount",
        f"{formats.decimal_field(formats.quote('EJ'), 'qtd_amount', 12, 2, True)} AS signed_text",
        f"{formats.decimal_field(formats.quote('A7'), 'tax_rate', 10, 4, False)} AS unsigned_text",
    )


@query
def fmt_date(spark, sf):
    return _worker(spark, sf).selectExpr(
        "worker_sk",
        f"{formats.date_field(formats.quote('SY'), 'birth_date', 'yyyyMMdd')} AS birth",
        f"{formats.date_field(formats.quote('PF'), 'termination_date', 'MMddyyyy')} AS ended",
    )


# --- taxes ----------------------------------------------------------------------


@query
def tax_latest(spark, sf):
    return _amounts(spark, sf).select(
        *TAX_ROW, "organization_unit_sk", *taxes.ZERO_DEFAULT, "qtd_amount_count", "ytd_amount_count"
    )


@query
def jurisdiction(spark, sf):
    return _amounts(spark, sf).selectExpr(
        "worker_sk", "payroll_run_sk", "state_code", "local_code", "jurisdiction",
        f"{jurisdiction_key('jurisdiction')} AS juris_key", f"{jurisdiction_order('jurisdiction')} AS juris_ord",
        f"{jurisdiction_class('jurisdiction')} AS juris_class",
    )


@query
def oos_amounts(spark, sf):
    return _amounts(spark, sf).select(*TAX_ROW, *taxes.fixed.OUT_OF_STATE_KEYS)


@query
def tax_profile_join(spark, sf):
    return _joined(spark, sf).select(*TAX_ROW, "state_code", "local_code", *taxes.PROFILE_VALUES)


@query
def canonical_tax_type(spark, sf):
    return _canonical(spark, sf).select(*TAX_ROW)


@query
def tax_code_lookup(spark, sf):
    """Rows per tax type, measure and looked-up code; no code is an empty one."""
    coded = taxes.with_cells(_canonical(spark, sf), spec_jobs.default_specs())
    cells = ", ".join(
        f"named_struct('measure', '{m}', 'code', coalesce({taxes.slot_code(m, kind)}, ''))"
        for _, m, kind, _, _ in taxes.slots()
        if kind != "place"
    )
    return coded.selectExpr("tax_type", f"inline(array({cells}))").groupBy("tax_type", "measure", "code").agg(
        F.count("*").alias("row_count")
    )


def _of_kind(spark, sf, *kinds):
    measures = [m for _, m, kind, _, _ in taxes.slots() if kind in kinds]
    return _fields(spark, sf).filter(F.col("measure").isin(*measures))


@query
def tax_amount_fields(spark, sf):
    return _of_kind(spark, sf, "amount")


@query
def tax_text_fields(spark, sf):
    return _of_kind(spark, sf, "text", "count").drop("overflow")


@query
def lived_in_field(spark, sf):
    return _of_kind(spark, sf, "place").drop("overflow")


@query
def value_report(spark, sf):
    return taxes.value_report(_fields(spark, sf), _snapshot(spark, sf))


@query
def tax_row_fields(spark, sf):
    arrays = taxes.tax_field_arrays(_canonical(spark, sf), spec_jobs.default_specs(), TAX_ROW)
    return arrays.select(*TAX_ROW, F.posexplode("fields").alias("seq", "text"))


def _field_arrays(spark, sf) -> DataFrame:
    return taxes.tax_field_arrays(_canonical(spark, sf), spec_jobs.default_specs(), TAX_ROW)


@query
def tax_groups(spark, sf):
    fields = groups.ordered_fields(_field_arrays(spark, sf), hot_workers(_snapshot(spark, sf)))
    return fields.selectExpr(*PERIOD, f"{jurisdiction_key('jurisdiction')} AS juris", "seq", "text")


@query
def level_merge(spark, sf):
    rows = stage(_field_arrays(spark, sf), "coded-rows")
    fields = groups.ordered_fields(rows, hot_workers(_snapshot(spark, sf)))
    classes = rows.select(*groups.GROUP).distinct().withColumn("juris_class", F.expr(jurisdiction_class("jurisdiction")))
    arrays = workers.level_arrays(_profiled(spark, sf), spec_jobs.default_specs(), ["worker_sk"])
    return groups.merge_levels(fields, classes, arrays)


# --- mandatory fields -------------------------------------------------------------


def _periods(spark, sf) -> DataFrame:
    return workers.workers_in_period(_worker(spark, sf), _snapshot(spark, sf))


@query
def mandatory_missing(spark, sf):
    return mandatory.missing_fields(_canonical(spark, sf), _periods(spark, sf), spec_jobs.default_specs())


@query
def mandatory_coverage(spark, sf):
    return mandatory.coverage(_canonical(spark, sf), _periods(spark, sf), spec_jobs.default_specs())


@query
def mandatory_summary(spark, sf):
    return mandatory.summary(_canonical(spark, sf), _periods(spark, sf), spec_jobs.default_specs())


@query
def mandatory_backfill(spark, sf):
    """Tax rows with the default rows added, counted per jurisdiction and type."""
    rows = mandatory.backfill(_canonical(spark, sf), _periods(spark, sf), spec_jobs.default_specs())
    return rows.groupBy("year", "quarter", "jurisdiction", "tax_type", "is_employer_tax").agg(
        F.count("*").alias("row_count"), F.count("payroll_run_sk").alias("real_rows"),
        F.sum("qtd_amount").cast("decimal(28,2)").alias("qtd_total"),
        F.sum("ytd_amount").cast("decimal(28,2)").alias("ytd_total"),
    )


# --- lines and files ----------------------------------------------------------------


@query
def employee_lines(spark, sf):
    return site_files.line_rows(_in(spark, sf))[0]


@query
def tax_lines(spark, sf):
    return site_files.line_rows(_in(spark, sf))[1]


@query
def rewrap_lines(spark, sf):
    """All fields of a worker as one long line, wrapped again."""
    fields = workers.worker_fields(_profiled(spark, sf), spec_jobs.default_specs())
    long = fields.groupBy("worker_sk").agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(ord, text))), f -> f.text), '') AS body")
    )
    return long.selectExpr("worker_sk", f"concat({packing.WORKER_PREFIX}, body) AS line").selectExpr(
        "worker_sk", f"posexplode({packing.rewrap('line')}) AS (seq, value)"
    )


@query
def file_header(spark, sf):
    stamp = F.lit(RUN_TIME).cast("timestamp")
    return queue.site_periods(_queue(spark, sf)).select(
        "site_id", "year", "quarter", assembly.file_header(F.col("year"), F.col("quarter"), stamp).alias("value")
    )


def _period_companies(spark, sf) -> DataFrame:
    return _periods(spark, sf).select("branch_code", "company_code", "year", "quarter").distinct()


@query
def company_header(spark, sf):
    value = assembly.company_header(F.col("branch_code"), F.col("company_code"))
    return _period_companies(spark, sf).withColumn("value", value)


@query
def company_header_160(spark, sf):
    value = assembly.company_header_padded(F.col("branch_code"), F.col("company_code"))
    return _period_companies(spark, sf).withColumn("value", value)


@query
def site_file(spark, sf):
    return site_files.site_file(_in(spark, sf), RUN_TIME)


def _written(spark, sf, decisions=None, inputs=None) -> tuple[str, DataFrame]:
    """The files written as text in the shared folder, compressed, and their manifest."""
    inputs = inputs or _in(spark, sf)
    staged = stage(site_files.packets(inputs, decisions=decisions), "packets")
    path = f"{shared_folder(spark)}/site-files-{uuid.uuid4().hex}"
    text_files.write_site_files(assembly.ordered_packets(staged, RUN_TIME), path, compression="gzip")
    names = queue.output_names(queue.site_periods(inputs.queue), RUN_TIME)
    return path, stage(text_files.manifest(spark, path, names), "manifest")


@query
def write_site_files(spark, sf):
    """The written files read back, numbered by their manifest."""
    return text_files.read_site_files(spark, *_written(spark, sf))


@query
def output_manifest(spark, sf):
    """Per file: registered name, lines over all parts, and whether the parts follow each other without a gap."""
    _, parts = _written(spark, sf)
    return parts.groupBy(*assembly.FILE, "outbound_file_name").agg(
        F.sum("line_count").alias("line_count"),
        (F.max(F.col("first_line") + F.col("line_count")) - 1 == F.sum("line_count")).alias("gapless"),
    )


@query
def status_update(spark, sf):
    """The queue after a run; counts come from the written files."""
    _, parts = _written(spark, sf)
    results = site_files.results(site_files.written_sizes(parts), queue.site_periods(_queue(spark, sf)))
    return queue.status_changes(_queue(spark, sf), results, _org(spark, sf), RUN_TIME)


SKIPPED_SITE = "S003"


@query
def status_update_with_skips(spark, sf):
    """The same where the whole output of one site's companies is skipped."""
    decisions = _org(spark, sf).filter(F.col("site_id") == SKIPPED_SITE).selectExpr(
        "organization_unit_sk AS company_error_sk", "1 AS rule_id", "'SKIP_COMPANY_OUTPUT' AS scope", "branch_code", "company_code",
        "CAST(NULL AS BIGINT) AS worker_sk", "CAST(NULL AS STRING) AS jurisdiction", "CAST(NULL AS STRING) AS tax_type",
        "CAST(array() AS ARRAY<STRING>) AS codes",
    )
    _, parts = _written(spark, sf, skips.PacketDecisions.fold(decisions))
    periods = queue.site_periods(_queue(spark, sf))
    results = site_files.results(site_files.written_sizes(parts), periods, site_files.files_with_workers(_in(spark, sf)))
    return queue.status_changes(_queue(spark, sf), results, _org(spark, sf), RUN_TIME)


# --- unreadable input --------------------------------------------------------------------

# Sample damage: (input, column, damaged value, rows).
DAMAGE = (
    ("fx_snapshot", "qtd_amount", "12,50x", "company_code = 'C003' AND payroll_run_sk % 7 = 0"),
    ("fx_snapshot", "year", "19x6", "company_code = 'C003' AND payroll_run_sk % 11 = 0"),
    ("fx_worker", "birth_date", "1990-13-45", "company_code = 'C008' AND worker_sk % 3 = 0"),
    ("fx_address", "worker_sk", "W?", "worker_sk % 97 = 0 AND type = 'Mail'"),
)


def _raw(spark, sf) -> dict[str, DataFrame]:
    """The inputs as delivered: damaged columns are text."""
    out = {}
    for name, view in sample_views.INPUT_VIEWS.items():
        df = sample_views.view(spark, sf, view)
        for _, column, value, rows in (d for d in DAMAGE if d[0] == view):
            df = df.withColumn(f"{column}_text", F.expr(f"CASE WHEN {rows} THEN '{value}' ELSE CAST({column} AS STRING) END"))
        for _, column, *_ in (d for d in DAMAGE if d[0] == view):
            df = df.drop(column).withColumnRenamed(f"{column}_text", column)
        out[name] = df
    return out


@query
def quarantine_(spark, sf):
    """Every value that can't be read, with its row's company and worker."""
    return quarantine.check(_raw(spark, sf)).rejects


def _status_without_damaged(spark, sf, partial: str) -> DataFrame:
    checked = quarantine.check(_raw(spark, sf))
    inputs = worker_lines.Inputs(**checked.inputs)
    _, parts = _written(spark, sf, inputs=inputs)
    results = site_files.results(site_files.written_sizes(parts), queue.site_periods(inputs.queue))
    changes = queue.status_changes(inputs.queue, results, inputs.organization, RUN_TIME)
    return quarantine.mark_status(changes, inputs.queue, checked.companies, inputs.organization, partial)


@query
def status_update_with_quarantine(spark, sf):
    """The queue after a run over damaged inputs: two companies are left out, all other lines are written."""
    return _status_without_damaged(spark, sf, "GENERATED")


# Sample runs: start and end. The first loses one site's files, the second repeats what failed, the third never ends.
RUNS = (
    ("run-1", RUN_TIME, "2026-01-15 09:10:00"),
    ("run-2", "2026-01-16 08:30:00", "2026-01-16 08:45:00"),
    ("run-3", "2026-01-17 08:30:00", None),
)
LOST_SITE, REPEATED_QUARTER = "S002", 1


@query
def status_history(spark, sf):
    """The queue after three runs, folded from their events; the first run's events are written twice."""
    path = f"{shared_folder(spark)}/file-events-{uuid.uuid4().hex}"
    files, organization = _queue(spark, sf), _org(spark, sf)
    _, parts = _written(spark, sf)
    outcome = site_files.results(site_files.written_sizes(parts), queue.site_periods(files))
    lost = outcome.withColumn("record_count", F.when(F.col("site_id") != LOST_SITE, F.col("record_count")))

    def run(number, of, outcome):
        run_id, start, end = RUNS[number]
        entries = history.started(of, run_id, start)
        history.write_events(entries, path)
        if end:
            history.write_events(history.ended(queue.status_changes(of, outcome, organization, start), entries, run_id, end), path)

    run(0, files, lost)
    run(0, files, lost)
    state = history.folded(files, history.read_events(spark, path))
    run(1, stage(history.requeued(state), "requeued"), outcome)
    state = history.folded(files, history.read_events(spark, path))
    again = state.filter((F.col("site_id") == LOST_SITE) & (F.col("quarter") == REPEATED_QUARTER))
    run(2, stage(history.requeued(again, ("GENERATED",)), "requeued"), outcome)
    state = history.folded(files, history.read_events(spark, path))
    return state.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in ("created_at", "updated_at")})


@query
def batch_summary(spark, sf):
    return queue.batch_summary(status_update(spark, sf))


# --- errors and skips ------------------------------------------------------------------


@query
def normalize_category_(spark, sf):
    raw = sample_views.view(spark, sf, "fx_error").select("company_error_sk", "raw_category")
    return raw.select("company_error_sk", normalize_category(F.col("raw_category")).alias("category"))


@query
def classify_errors(spark, sf):
    return errors.classify(
        sample_views.view(spark, sf, "fx_error").select("company_error_sk", "raw_category"), "raw_category"
    )


@query
def impact_flags(spark, sf):
    return sample_views.view(spark, sf, "fx_error").select(
        "company_error_sk", impact_flag(F.col("raw_flag")).alias("impacts")
    )


@query
def catalog_profile(spark, sf):
    catalog = errors.default_catalog(spark).select("error_code", "category")
    return errors.catalog_profile(_errors(spark, sf).select("error_code").join(catalog, "error_code"))


@query
def active_errors(spark, sf):
    return errors.active_errors(_errors(spark, sf), errors.default_catalog(spark))


@query
def resolve_category(spark, sf):
    resolved = errors.resolve_category(active_errors(spark, sf), errors.default_rules())
    return resolved.select("company_error_sk", "error_code", "resolved_category", "resolved_by")


@query
def resolve_scopes(spark, sf):
    return _decisions(spark, sf).withColumn("codes", F.array_join("codes", ","))


def _tax_rows(spark, sf) -> DataFrame:
    return _canonical(spark, sf).select("branch_code", "company_code", *TAX_ROW)


@query
def skip_code(spark, sf):
    return skips.skip_codes(_fields(spark, sf, "branch_code", "company_code"), _decisions(spark, sf)).select(
        *TAX_ROW, "code", "text"
    )


@query
def skip_group(spark, sf):
    scope = {"WAGE_PLAN_ERROR": "SKIP_NON_REPORTING_CODES", "COMPANY_TAX_ID_ERROR": "SKIP_REPORTING_CODES"}
    fields = _fields(spark, sf, "branch_code", "company_code")
    return skips.skip_codes(fields, _decisions(spark, sf, scope), _groups(spark)).select(*TAX_ROW, "code", "text")


@query
def skip_jurisdiction(spark, sf):
    return skips.skip_jurisdiction(_tax_rows(spark, sf), _decisions(spark, sf))


@query
def skip_worker_tax(spark, sf):
    decisions = _decisions(spark, sf, {"EMPLOYEE_PROFILE_ERROR": "SKIP_ALL_TAX_FOR_EMPLOYEE"})
    return skips.skip_worker_tax(_tax_rows(spark, sf), decisions)


@query
def skip_worker(spark, sf):
    return skips.skip_worker(scan_worker(spark, sf), _decisions(spark, sf))


@query
def skip_company_tax(spark, sf):
    return skips.skip_company_tax(_tax_rows(spark, sf), _decisions(spark, sf))


@query
def skip_company(spark, sf):
    decisions = _decisions(spark, sf, {"COMPANY_TAX_ID_ERROR": "SKIP_COMPANY_OUTPUT"})
    return skips.skip_company(scan_worker(spark, sf), decisions)


@query
def skip_merge(spark, sf):
    return skips.merge(_decisions(spark, sf))


def _audit(spark, sf) -> DataFrame:
    """The coded tax rows are written once; rows, fields and totals are counted from them."""
    entity = ("branch_code", "company_code", "worker_sk")
    specs = spec_jobs.default_specs()
    coded = stage(taxes.tax_field_arrays(_canonical(spark, sf), specs, [*entity, "jurisdiction", "tax_type"]), "audit-rows")
    fields = coded.select(*entity, "jurisdiction", F.explode("fields").alias("text")).withColumn("code", F.left("text", F.lit(2)))
    profiled = _profiled(spark, sf)
    people = profiled.select(*entity)
    return skips.audit(
        _decisions(spark, sf), coded.drop("fields"), fields, people, workers.worker_fields(profiled, specs), _groups(spark)
    )


@query
def skip_audit(spark, sf):
    return _audit(spark, sf)


@query
def error_write_status(spark, sf):
    return skips.error_write_status(_errors(spark, sf), _audit(spark, sf))


@query
def skip_audit_lines(spark, sf):
    """Per decision and file of its company: worker lines and tax lines without it and with it alone."""
    return line_audit.audit(_in(spark, sf), _decisions(spark, sf), active_errors(spark, sf))


# Sample rule table: (id, category, side, scope, target, codes, group, needs place, active, from, to).
RULE_ROWS = (
    (1, "NO_IMPACT_ERROR", None, "NO_SKIP", None, [], None, None, None, None, None),
    (2, "SPECIFIC_TAX_CODE_ERROR", "TAX", "SKIP_CODE", "CODES", ["CS", "EJ"], None, None, None, "2024-01-05", None),
    (3, "WAGE_PLAN_ERROR", "TAX", "SKIP_TAX_JURISDICTION", "JURISDICTION", [], None, True, True, None, None),
    (4, "EMPLOYEE_PROFILE_ERROR", "WORKER", "SKIP_REPORTING_CODES", "GROUP", ["EK"], "IDENTITY", None, True, "2024-01-10", "2024-01-25"),
    (5, "COMPANY_TAX_ID_ERROR", "BOTH", "SKIP_COMPANY_TAX_OUTPUT", "COMPANY", [], None, None, True, None, "2024-01-04"),
    (6, "COMPANY_TAX_ID_ERROR", "BOTH", "SKIP_COMPANY_OUTPUT", "COMPANY", [], None, None, False, None, None),
)
GROUP_CODES = (("IDENTITY", "DD"), ("IDENTITY", "SY"), ("OTHER", "EJ"))


def _table_decisions(spark, sf) -> DataFrame:
    text = errors.RULE_TABLE.replace("DATE", "STRING")
    rules = spark.createDataFrame(list(RULE_ROWS), text).selectExpr(
        "* EXCEPT (effective_from, effective_to)", "CAST(effective_from AS DATE) AS effective_from", "CAST(effective_to AS DATE) AS effective_to"
    )
    group_codes = spark.createDataFrame(list(GROUP_CODES), "reporting_group STRING, code STRING")
    resolved = errors.resolve_category(active_errors(spark, sf), errors.default_rules())
    return stage(errors.resolve_by_table(resolved, _errors(spark, sf), rules, _org(spark, sf), group_codes), "decisions")


@query
def resolve_scopes_by_table(spark, sf):
    """Decisions from a rule table with sides, groups and dates."""
    return _table_decisions(spark, sf).withColumn("codes", F.array_join("codes", ","))


@query
def site_file_with_rule_table(spark, sf):
    """All lines where code rules hold for one side."""
    return site_files.site_file(_in(spark, sf), RUN_TIME, decisions=skips.PacketDecisions.fold(_table_decisions(spark, sf)))


# Sample run: one site's workers are missing, so its files fail; one site is not queued.
FAILED_SITE, UNQUEUED_SITE = "S002", "S001"


@query
def error_write_status_after_run(spark, sf):
    """Write status after a run with skips in which one site fails and one is not queued."""
    inputs, organization = _in(spark, sf), _org(spark, sf)
    missing = organization.where(F.col("site_id") == FAILED_SITE).select("branch_code", "company_code").distinct()
    inputs = replace(
        inputs,
        worker=inputs.worker.join(missing, ["branch_code", "company_code"], "left_anti").select(*inputs.worker.columns),
        queue=inputs.queue.where(f"NOT (site_id <=> '{UNQUEUED_SITE}' AND status <=> 'QUEUED')"),
    )
    _, parts = _written(spark, sf, skips.PacketDecisions.fold(_decisions(spark, sf), _groups(spark)), inputs)
    periods = queue.site_periods(inputs.queue)
    results = site_files.results(site_files.written_sizes(parts), periods, site_files.files_with_workers(inputs))
    changes = queue.status_changes(inputs.queue, results, organization, RUN_TIME)
    units = skips.seen_units(changes, inputs.queue, organization)
    return skips.write_status_after_run(_errors(spark, sf), _audit(spark, sf), units)


# Later versions of catalog rows, with repeats: (code, legacy code, type, category, deposit, filing), from.
CATALOG_VERSIONS = (
    (("SSN_NON_NUM", "SSN1", "SSN", "REGISTRATION", True, True), "2024-01-10 00:00:00"),
    (("SSN_NON_NUM", "SSN1", "SSN", "WAGEPLAN", False, True), "2024-01-20 00:00:00"),
    (("SSN_NON_NUM", "SSN1", "SSN", "WAGEPLAN", False, True), "2024-01-20 00:00:00"),
    (("FEIN_IS_MISSING", "F1", "TAX_ID", "PAYROLL", False, False), "2024-01-15 12:00:00"),
    (("FEIN_IS_MISSING", "F2", "TAX_ID", "WAGEPLAN", True, False), "2024-01-15 12:00:00"),
    (("NOT_IN_CATALOG", "N1", "OTHER", "PAYROLL", True, True), "2024-01-25 00:00:00"),
    (("E002", "E2", "SSN", "REGISTRATION", True, True), "2099-01-01 00:00:00"),
)


@query
def active_errors_as_of(spark, sf):
    """Open errors with the catalog version of their date."""
    found = errors.active_errors(_errors(spark, sf), errors.versioned_catalog(spark, CATALOG_VERSIONS))
    return found.withColumn("effective_from", F.date_format("effective_from", "yyyy-MM-dd HH:mm:ss"))


@query
def site_file_with_skips(spark, sf):
    decisions = skips.PacketDecisions.fold(_decisions(spark, sf), _groups(spark))
    return site_files.site_file(_in(spark, sf), RUN_TIME, decisions=decisions)


# --- quality ---------------------------------------------------------------------------


def _quality_rows(spark, sf) -> DataFrame:
    """Canonical snapshot rows with the optional measures."""
    rows = schemas.conform(sample_views.view(spark, sf, "fx_snapshot", lines_once=True), schemas.SNAPSHOT, "fx_snapshot", blank_as_null=True)
    return taxes.canonical_types(rows, spec_jobs.default_specs())


@query
def dq_ssn(spark, sf):
    return quality.ssn_rules(_worker(spark, sf))


@query
def dq_missing(spark, sf):
    return quality.missing_rules(_worker(spark, sf), _org(spark, sf))


@query
def dq_tax_no_wage(spark, sf):
    return quality.row_rules(_quality_rows(spark, sf), quality.TAX_NO_WAGE)


@query
def dq_wage_order(spark, sf):
    return quality.row_rules(_quality_rows(spark, sf), quality.WAGE_ORDER)


@query
def dq_negative(spark, sf):
    return quality.row_rules(_quality_rows(spark, sf), quality.NEGATIVE)


@query
def dq_wage_no_hours(spark, sf):
    return quality.row_rules(_quality_rows(spark, sf), quality.WAGE_NO_HOURS)


@query
def dq_bounds(spark, sf):
    return quality.bounds_rules(_quality_rows(spark, sf))


# A rule that a site adds by rows of its own: two conditions.
ADDED_CHECKS = (("NY_SIT_TAX_GT_WAGE", "NY", "SIT", "qtd_amount", ">", "qtd_taxable_amount"), ("NY_SIT_TAX_GT_WAGE", "NY", "SIT", "qtd_amount", ">=", "100.5"))


@query
def dq_all(spark, sf):
    """All row rules and bounds, and one added by rows, in one scan."""
    return quality.table_rules(_quality_rows(spark, sf), quality.check_table(spark, quality.ROW_CHECKS + ADDED_CHECKS))


@query
def dq_cross_type(spark, sf):
    return quality.cross_type_rules(_quality_rows(spark, sf))


@query
def dq_text(spark, sf):
    rows = sample_views.view(spark, sf, "fx_snapshot")
    return quality.wv_text_rules(_worker(spark, sf), rows, place_states=("DE",))


# Sample mapping of tax types to the codes of the federal rule.
FEDERAL_CODES = (
    ("SSEE", "qtd_taxable_amount", "FP"), ("MEDEE", "qtd_taxable_amount", "IC"), ("FIT", "qtd_amount", "EJ"),
    ("COBRA-CR", "qtd_amount", "IA"), ("MEDER", "qtd_taxable_amount", "ZE"), ("MEDER", "qtd_amount", "ZF"),
    ("SSER", "qtd_amount", "6B"), ("SIT", "qtd_amount", "7A"), ("CIT", "qtd_amount", "FL"), ("SDIEE", "qtd_amount", "5Y"),
    ("SUIER", "qtd_amount", "EL"),
)


@query
def dq_federal(spark, sf):
    entries = ", ".join(
        f"CASE WHEN tax_type = '{t}' THEN named_struct('code', '{code}', 'amount', {measure}) END"
        for t, measure, code in FEDERAL_CODES
    )
    amounts = _quality_rows(spark, sf).selectExpr(*PERIOD, f"inline(array_compact(array({entries})))")
    flagged = _worker(spark, sf).filter("third_party_sick_pay_indicator")
    return quality.federal_rule(amounts, flagged)


QUERIES["normalize_category"] = QUERIES.pop("normalize_category_")
QUERIES["quarantine"] = QUERIES.pop("quarantine_")
