"""Packing and re-wrapping against straightforward loops."""

import random
import string

from pyspark.sql import functions as F

from quartermill.functions import packing
from quartermill.operators import segments

PREFIX = "******CA    "


def greedy(fields, prefix, width=160):
    lines, line = [], ""
    for text in fields:
        if not text:
            continue
        if line and len(line) + len(text) > width:
            lines.append(line)
            line = ""
        line = (line or prefix) + text
    return lines + ([line] if line else [])


def random_fields(rng):
    sizes = [rng.choice([0, 1, 3, 9, 14, 16, 42, 82, 147, 148, 149, 200]) for _ in range(rng.randint(0, 40))]
    return [None if rng.random() < 0.1 else rng.choice(string.ascii_uppercase) * n for n in sizes]


def test_pack_matches_greedy_loop(spark):
    rng = random.Random(1)
    cases = [(i, random_fields(rng)) for i in range(300)]
    df = spark.createDataFrame(cases, "id int, fields array<string>")
    got = df.selectExpr(
        "id", f"{packing.pack('fields', repr(PREFIX))} AS tax", f"{packing.worker_lines('fields')} AS own"
    ).collect()
    expected = dict(cases)
    for row in got:
        assert row["tax"] == greedy(expected[row["id"]], PREFIX)
        assert row["own"] == (greedy(expected[row["id"]], "******      ") or ["******      "])


def test_pack_rows_equals_field_by_field(spark):
    rng = random.Random(2)
    cases = []
    for i in range(200):
        rows = []
        for juris in sorted(rng.sample(["F     ", "CA    ", "NJ0001", "NY    "], rng.randint(0, 4))):
            for _ in range(rng.randint(1, 6)):
                fields = [x for x in random_fields(rng)[: rng.randint(0, 6)] if x]
                rows.append((juris, "".join(fields), fields))
        cases.append((i, rows))
    df = spark.createDataFrame(cases, "id int, rows array<struct<juris:string,text:string,fields:array<string>>>")
    got = df.selectExpr("id", f"{packing.pack_rows('rows', packing.tax_prefix('r.juris'))} AS lines").collect()
    for row in got:
        expected, rows = [], dict(cases)[row["id"]]
        for juris in dict.fromkeys(r[0] for r in rows):
            expected += greedy([t for r in rows if r[0] == juris for t in r[2]], "******" + juris)
        assert row["lines"] == expected


def is_code(text):
    return len(text) == 2 and all(c in string.ascii_uppercase + string.digits for c in text) and not text.isdigit()


def rewrap_loop(line):
    if not line:
        return []
    if len(line) <= 160:
        return [line]

    def cut(text, room):
        if len(text) <= room and room == 148:
            return len(text)
        return max((i for i in range(1, room - 1) if is_code(text[i : i + 2])), default=min(room, len(text)))

    at = cut(line, 160)
    pieces, rest = [line[:at]], line[at:]
    while rest:
        at = cut(rest, 148)
        pieces.append("******      " + rest[:at])
        rest = rest[at:]
    return pieces


def test_rewrap_matches_loop(spark):
    rng = random.Random(3)
    alphabet = "ABC019 abc.*"
    cases = [(i, "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 5, 160, 161, 300, 700])))) for i in range(200)]
    cases += [(900, "9" * 500), (901, "a" * 161), (902, None)]
    df = spark.createDataFrame(cases, "id int, line string")
    for row in df.selectExpr("id", f"{packing.rewrap('line')} AS pieces").collect():
        line = dict(cases)[row["id"]]
        assert row["pieces"] == rewrap_loop(line)
        joined = "".join(p if i == 0 else p[12:] for i, p in enumerate(row["pieces"]))
        assert joined == (line or "")


def test_segments_match_greedy_loop(spark):
    """A group cut into many chunks packs like one sequence; equal rows stay."""
    rng = random.Random(4)
    rows = []
    for group in range(3):
        for order in range(120):
            fields = [x for x in random_fields(rng)[:3] if x]
            rows.append((group, order, PREFIX, fields))
        # Many identical rows, which no order column can tell apart.
        rows += [(group, 500, PREFIX, ["ZZ+0000000001"])] * 90
    df = spark.createDataFrame(rows, "g int, o int, prefix string, fields array<string>")
    chunked = segments.ordered_chunks(df, ["g"], ["o"], len(rows), chunk_rows=40)
    assert chunked.select("chunk").distinct().count() > 5
    lines = segments.packed_lines(chunked, ["g"], ["o"])
    packets = segments.line_packets(lines, ["g"], packet_lines=7)
    got = packets.orderBy("g", "block").collect()
    assert all(p["n_lines"] == len(p["lines"]) <= 7 for p in got)
    for group in range(3):
        merged = [line for p in got if p["g"] == group for line in p["lines"]]
        fields = [t for r in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]) for t in r[3]]
        assert merged == greedy(fields, PREFIX)


def test_counts_are_those_of_the_packed_lines(spark):
    rng = random.Random(3)
    cases = []
    for i in range(200):
        rows = []
        for juris in sorted(rng.sample(["F     ", "CA    ", "NJ0001", "NY    "], rng.randint(0, 4))):
            for _ in range(rng.randint(1, 6)):
                fields = random_fields(rng)[: rng.randint(0, 6)]
                rows.append((juris, "".join(x or "" for x in fields), fields))
        cases.append((i, rows, random_fields(rng)))
    schema = "id int, rows array<struct<juris:string,text:string,fields:array<string>>>, fields array<string>"
    lines = packing.pack_rows("rows", packing.tax_prefix("r.juris"))
    found = spark.createDataFrame(cases, schema).selectExpr(
        f"size({lines}) AS tax", f"{packing.count_rows('rows')} AS tax_count",
        f"size({packing.worker_lines('fields')}) AS own", f"{packing.count_worker_lines('fields')} AS own_count",
    ).collect()
    assert sum(r.tax for r in found) > 1_000
    assert all(r.tax == r.tax_count and r.own == r.own_count for r in found)
