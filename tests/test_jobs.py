"""Whole jobs on a small company: scenarios, skips, numbering, sink, hot workers."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quartermill import schemas
from quartermill.operators import assembly, errors, queue, skips
from quartermill.operators.sizing import hot_workers as find_hot
from quartermill.plans import hot_workers, site_files
from quartermill.plans.worker_lines import Inputs
from quartermill.session import remove_staged, stage
from quartermill.sources import sample_views, text_files
from quartermill.specs.compile import Specs, default_specs

RUN_TIME = "2026-04-25 11:03:58"


def frame(spark, schema, rows):
    """Rows given as dicts; columns left out are NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def tax(worker, state, tax_type, **amounts):
    row = dict(
        worker_sk=worker, organization_unit_sk=227, branch_code="ST", company_code="C059", payroll_run_sk=9,
        state_code=state, tax_type=tax_type, is_employer_tax=False, year=2026, quarter=1,
    )
    return row | {k: Decimal(v) for k, v in amounts.items()}


@pytest.fixture(scope="module")
def company(spark):
    """Two workers of one company: federal rows for both, CA for both, IL for one."""
    workers = [
        dict(worker_sk=361, branch_code="ST", company_code="C059", given_name="Cuneal", family_name="Jackson", ssn="123456789",
             birth_date=dt.date(1986, 1, 31), hire_date=dt.date(2023, 12, 31)),
        dict(worker_sk=362, branch_code="ST", company_code="C059", given_name="Maya", family_name="Lee", ssn="987654321",
             birth_date=dt.date(1990, 5, 12), hire_date=dt.date(2024, 1, 1)),
    ]
    snapshot = [
        tax(361, None, "FIT", qtd_amount="123.45", ytd_amount="456.78"),
        tax(361, "CA", "SIT", qtd_gross_wages="2345.67", ytd_gross_wages="7000"),
        tax(361, "IL", "SIT", qtd_gross_wages="1457.86", ytd_gross_wages="9304.56"),
        tax(362, None, "FIT", qtd_amount="210", ytd_amount="900"),
        tax(362, "CA", "SIT", qtd_gross_wages="3000", ytd_gross_wages="8000"),
        # An earlier run, which must not show.
        tax(362, "CA", "SIT", qtd_gross_wages="1", ytd_gross_wages="1") | dict(payroll_run_sk=8),
    ]
    return Inputs(
        worker=frame(spark, schemas.WORKER, workers),
        address=frame(spark, schemas.ADDRESS, []),
        snapshot=frame(spark, schemas.SNAPSHOT, snapshot),
        profile=frame(spark, schemas.PROFILE, []),
        organization=frame(spark, schemas.ORGANIZATION, [dict(organization_unit_sk=227, branch_code="ST", company_code="C059", site_id="S059")]),
        queue=frame(spark, schemas.QUEUE, [dict(batch_id="B1", site_id="S059", year=2026, quarter=1, status="QUEUED", file_type="QUARTER")]),
    )


@pytest.fixture(scope="module")
def short_specs():
    """Name, number and dates only, and no mandatory cells, as in the worked examples."""
    base = default_specs()
    fields = tuple(r for r in base.fields if r[2] in ("CS", "CU", "DD", "SY", "NZ"))
    return Specs(fields, tuple(r for r in base.tax if not r[6]), base.pairs)


def decisions(spark, scope, **target):
    columns = "company_error_sk bigint, rule_id int, scope string, branch_code string, company_code string, worker_sk bigint, jurisdiction string, tax_type string, codes array<string>"
    values = dict(company_error_sk=1, rule_id=1, scope=scope, branch_code="ST", company_code="C059", codes=[]) | target
    names = [c.split()[0] for c in columns.split(", ")]
    return skips.PacketDecisions.fold(spark.createDataFrame([tuple(values.get(n) for n in names)], columns))


def lines(df):
    return [r["value"] for r in df.orderBy("site_id", "year", "quarter", "line_no").collect()]


def run(company, specs, decision=None, **options):
    return lines(site_files.site_file(company, RUN_TIME, specs, decision, **options))


def test_baseline_file(company, short_specs):
    got = run(company, short_specs)
    assert len(got) == 10
    assert got[0] == " " * 12 + "260425110358" + "QTRFILINGS" + "261" + " " * 11 + "Q" + " " * 111
    assert len(got[0]) == 160
    assert got[1] == "      STC05910000NN             Y"
    assert got[2] == "******      CSCUNEAL      CUJACKSON       DD123-45-6789SY19860131NZ12312023"
    assert got[3] == "******F     EJ+00000012345EK+0000000045678DFS"
    assert got[4] == "******CA    MV+00000234567NT+00000700000DHS"
    assert got[5] == "******IL    MV+00000145786NT+00000930456DHS"
    assert got[6].startswith("******      CSMAYA")
    assert got[8] == "******CA    MV+00000300000NT+00000800000DHS"
    assert got[9] == "9999999999990000010"


@pytest.mark.parametrize(
    "scope, target, count",
    [
        ("NO_SKIP", {}, 10),
        ("SKIP_CODE", dict(worker_sk=361, codes=["EJ"]), 10),
        ("SKIP_TAX_JURISDICTION", dict(jurisdiction="CA", tax_type="SIT"), 8),
        ("SKIP_TAX_JURISDICTION", dict(jurisdiction="CA"), 8),
        ("SKIP_TAX_JURISDICTION", dict(jurisdiction="CA", tax_type="SUIEE"), 10),
        ("SKIP_TAX_JURISDICTION", dict(jurisdiction="IL", worker_sk=361), 9),
        ("SKIP_ENTIRE_EMPLOYEE", dict(worker_sk=362), 7),
        ("SKIP_ALL_TAX_FOR_EMPLOYEE", dict(worker_sk=362), 8),
        ("SKIP_COMPANY_TAX_OUTPUT", {}, 5),
    ],
)
def test_skip_scenarios(spark, company, short_specs, scope, target, count):
    got = run(company, short_specs, decisions(spark, scope, **target))
    assert len(got) == count
    assert got[-1] == f"999999999999{count:07d}"
    if scope == "SKIP_CODE":
        assert got[3] == "******F     EK+0000000045678DFS"
        assert got[7] == "******F     EJ+00000021000EK+0000000090000DFS"


def test_company_output_skip_ends_as_skipped(spark, company, short_specs):
    decision = decisions(spark, "SKIP_COMPANY_OUTPUT")
    before = site_files.packets(company, short_specs)
    after = stage(site_files.packets(company, short_specs, decision), "packets")
    assert after.count() == 0
    periods = queue.site_periods(company.queue)
    sizes = assembly.file_sizes(after)
    results = site_files.results(sizes, periods, before)
    changes = queue.status_changes(company.queue, results, company.organization, RUN_TIME)
    assert changes.first()["status"] == "SKIPPED"
    failed = queue.status_changes(company.queue, site_files.results(sizes, periods), company.organization, RUN_TIME).first()
    assert (failed["status"], failed["error_message"]) == ("FAILED", "No worker data found for site: S059")


def test_backfill_and_skips_do_not_recreate(spark, company):
    got = run(company, default_specs())
    federal = [line for line in got if line.startswith("******F")]
    assert all("5E+0000000000000" in x and "5H+0000000000000" in x and "7H+00000000000" in x for x in federal)
    skipped = run(company, default_specs(), decisions(spark, "SKIP_TAX_JURISDICTION", jurisdiction="F"))
    assert not [line for line in skipped if line.startswith("******F")]


def test_null_strict_key_keeps_worker_without_tax_line(spark, company, short_specs):
    lost = company.snapshot.filter("worker_sk = 361").unionByName(
        company.snapshot.filter("worker_sk = 362 AND payroll_run_sk = 8").selectExpr(
            *[c if c != "payroll_run_sk" else "CAST(NULL AS BIGINT) AS payroll_run_sk" for c in company.snapshot.columns]
        )
    )
    from dataclasses import replace

    got = run(replace(company, snapshot=lost), short_specs)
    assert [x for x in got if "CSMAYA" in x]
    assert len(got) == 8


@pytest.mark.parametrize("with_skips", [False, True])
def test_hot_workers_give_the_same_files(spark, sf_dir, with_skips, monkeypatch):
    from quartermill.plans import registry

    inputs = sample_views.inputs(spark, sf_dir)
    decision = skips.PacketDecisions.fold(registry._decisions(spark, sf_dir), registry._groups(spark)) if with_skips else None
    limit = 66
    hot = find_hot(inputs.snapshot, inputs.profile, row_limit=limit)
    assert 1 <= hot.count() <= 12
    monkeypatch.setattr(hot_workers.packets, "__defaults__", (60,))
    usual = run(inputs, None, decision)
    assert run(inputs, None, decision, hot_row_limit=limit) == usual


def test_hot_groups_give_the_same_fields(spark, sf_dir):
    from quartermill.operators import groups, taxes
    from quartermill.plans import registry
    from quartermill.specs.compile import default_specs as base

    inputs = sample_views.inputs(spark, sf_dir)
    hot = find_hot(inputs.snapshot, row_limit=66)

    def fields(hot):
        rows = taxes.canonical_types(taxes.join_profile(taxes.with_amounts(taxes.latest_run(inputs.snapshot, hot)), inputs.profile), base())
        arrays = taxes.tax_field_arrays(rows, base(), registry.TAX_ROW)
        return sorted(map(tuple, groups.ordered_fields(arrays, hot, chunk_rows=60).collect()), key=repr)

    assert fields(hot) == fields(None)


def test_hot_line_rows_are_the_same(spark, sf_dir, monkeypatch):
    inputs = sample_views.inputs(spark, sf_dir)
    usual = [sorted(map(tuple, df.collect())) for df in site_files.line_rows(inputs)]
    monkeypatch.setattr(hot_workers.packets, "__defaults__", (60,))
    split = [sorted(map(tuple, df.collect())) for df in site_files.line_rows(inputs, hot_row_limit=70)]
    assert split == usual


def test_an_outlier_key_does_not_collapse_the_numbering_blocks(spark):
    keys = spark.range(20_000).selectExpr(
        "'S' AS site_id", "1995 AS year", "1 AS quarter", "'B' AS branch_code", "'C' AS company_code",
        "CASE WHEN id = 19999 THEN 4611686018427387904L ELSE id END AS worker_sk", "0L AS packet", "2 AS n_lines", "array('x', 'y') AS lines",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in assembly.numbering_blocks(keys, RUN_TIME).groupBy("block").count().collect()]
        numbered = assembly.numbered_lines(stage(keys, "packets"), RUN_TIME)
        got = numbered.agg(F.min("line_no"), F.max("line_no"), F.count_distinct("line_no")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 40_003 / 4
    assert tuple(got) == (1, 40_003, 40_003)


@pytest.mark.parametrize("ordered", [assembly.ordered_lines, assembly.ordered_packets])
def test_sink_writes_parts_in_line_order(spark, sf_dir, tmp_path, ordered):
    import glob

    staged = stage(site_files.packets(sample_views.inputs(spark, sf_dir)), "packets")
    out = str(tmp_path / "files")
    text_files.write_site_files(ordered(staged, RUN_TIME), out, pad_to=160)
    expected = {}
    for row in assembly.numbered_lines(staged, RUN_TIME).orderBy("line_no").collect():
        expected.setdefault((row["site_id"], row["year"], row["quarter"]), []).append(row["value"].ljust(160))
    for (site, year, quarter), wanted in expected.items():
        parts = sorted(glob.glob(f"{out}/site_id={site}/year={year}/quarter={quarter}/part-*"))
        written = [line for part in parts for line in open(part).read().splitlines()]
        assert written == wanted


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_written_lines_are_numbered_without_a_shuffle(spark, tmp_path, compression):
    values = ["a", "", "b  ", "\u00e9", "x" * 300, " ", "c\rd"]
    rows = [("S1", 2024, q, 1, "00", f"C{w % 3}", w, 0, [values[(w + i) % (6 if w % 10 else 7)] for i in range(7)]) for q in (1, 2) for w in range(50)]
    schema = "site_id string, year int, quarter int, part int, branch_code string, company_code string, worker_sk long, packet long, lines array<string>"
    out = str(tmp_path / "files")
    text_files.write_site_files(spark.createDataFrame(rows, schema), out, compression=compression, part_lines=16)
    names = spark.createDataFrame([("S1", 2024, q, f"n{q}") for q in (1, 2)], "site_id string, year int, quarter int, outbound_file_name string")
    parts = stage(text_files.manifest(spark, out, names), "manifest")
    assert parts.agg(F.max("line_count")).first()[0] <= 16 + 5 and parts.count() >= 2 * 350 // 16
    read = text_files.read_site_files(spark, out, parts)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    got = {q: [r.value for r in read.where(f"quarter = {q}").orderBy("line_no").collect()] for q in (1, 2)}
    # Text with a carriage return is read as two lines, by the manifest too.
    wanted = [v for r in sorted((r for r in rows if r[2] == 1), key=lambda r: (r[5], r[6])) for text in r[8] for v in text.split("\r")]
    assert got == {1: wanted, 2: wanted} and len(wanted) == 355
    assert read.agg(F.count_distinct("quarter", "line_no"), F.max("line_no")).first() == (710, 355)


def test_numbering_moves_no_line(spark, sf_dir):
    staged = stage(site_files.packets(sample_views.inputs(spark, sf_dir)), "packets")
    plan = assembly.numbered_lines(staged, RUN_TIME)._jdf.queryExecution().executedPlan().toString()
    # The written lines only meet the small table of shifts.
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.count("FileScan") == 1 and "BroadcastHashJoin" in plan


def test_packets_become_lines_after_the_shuffle(spark, sf_dir):
    staged = stage(site_files.packets(sample_views.inputs(spark, sf_dir)), "packets")
    plan = text_files.arranged(assembly.ordered_packets(staged, RUN_TIME))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    generate, exchange = ([i for i, line in enumerate(plan) if name in line] for name in ("Generate posexplode", "RepartitionByExpression"))
    # A plan is printed from its end: lines come out of the packets after the one shuffle.
    assert len(generate) == len(exchange) == 1 and generate[0] < exchange[0]


def test_parts_follow_by_number(spark):
    names = ["part-99999-u.c000.txt", "part-100000-u.c000.txt", "part-99999-u.c001.txt", "part-100000-u.c000.txt.gz", "other.txt"]
    rows = spark.createDataFrame([(f"file:/x/site_id=S1/part-9/{n}",) for n in names], "path string")
    got = [r.path.rsplit("/", 1)[1] for r in rows.orderBy(*text_files.part_number(F.col("path"))).collect()]
    assert got == ["other.txt", names[0], names[2], names[1], names[3]]


def test_sink_refuses_lines_without_value(spark, tmp_path):
    with pytest.raises(ValueError, match="value"):
        text_files.write_site_files(spark.range(1), str(tmp_path))


def test_staged_tables_can_be_removed(spark):
    rows = stage(spark.range(10), "rows")
    path = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    import os

    assert os.path.isdir(path)
    assert remove_staged(spark) >= 1 and not os.path.isdir(path)
    assert remove_staged(spark) == 0
