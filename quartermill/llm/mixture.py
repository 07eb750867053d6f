"""Time-varying curriculum: source targets, repeats, training positions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import WORD, block_count, hash_block, joined, running_total
from quartermill.session import stage

#: Weights by source rank, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Weight over training time, as (time, weight) corners, by source rank, repeating:
#: a source of the first kind fades, the second is level, the third grows.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
MOST = 3.0


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_targets(sources: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """Adds ``rank`` (0, 1, ... by source, null last), ``weight`` and ``target`` to (source, source_size).

    The rank needs one order over the distinct sources, never over documents.
    Targets share the sum of all sizes by weight. Sources over ``most`` times
    their size stop there and the excess is shared again, until none is above.
    Each turn aggregates the source table once.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("rank", rank).withColumn("weight", F.element_at(kinds, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = stage(ranked, "sources")
    share, stopped = None, 0
    while True:
        held = F.lit(False) if share is None else F.col("weight") * share >= most * F.col("source_size")
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(held, most * F.col("source_size")).otherwise(0.0)).alias("capped"),
            F.sum(F.when(~held, F.col("weight")).otherwise(0.0)).alias("open"),
            F.count_if(held).alias("stopped"),
        ).first()
        if share is not None and (row["stopped"] == stopped or not row["open"]):
            break
        stopped = row["stopped"]
        share = (float(row["all"] or 0) - (row["capped"] or 0.0)) / row["open"] if row["open"] else 0.0
    return ranked.withColumn("target", F.least(F.col("weight") * share, most * F.col("source_size")))


def curve(schedule) -> list[tuple[float, float, float, float]]:
    """Pieces (time, weight, slope, integral so far) of a piecewise linear weight, scaled to integral 1 over [0, 1]."""
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))
    pieces, so_far = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        if t1 > t0:
            pieces.append((t0, w0 / area, (w1 - w0) / (t1 - t0) / area, so_far))
            so_far += (t1 - t0) * (w0 + w1) / 2 / area
    return pieces


def time_of(share: Column, schedule) -> Column:
    """The training time in [0, 1] at which the integral of the schedule reaches ``share``."""
    out = None
    for time, weight, slope, before in curve(schedule):
        rest = share - F.lit(before)
        root = F.lit(weight) + F.sqrt(F.greatest(F.lit(0.0), F.lit(weight * weight) + F.lit(2.0 * slope) * rest))
        here = F.lit(time) + F.when(root > 0, F.lit(2.0) * rest / root).otherwise(F.lit(0.0))
        out = here if out is None else F.when(share >= before, here).otherwise(out)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out))


def plan(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, most: float = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, row (its number among equal ones), source_size, target, copies, taken, positions.

    Within its source a document lies at a place given by a hash of its id.
    Every document is taken floor(target / source size) times, and once more
    if its middle lies in the part of the source that the rest of the target
    covers; so a source misses its target by half a document at most. Copy k of
    a document sits k whole passes after its first. That place, as a share of
    the target, is what the integral of the source's weight schedule must have
    reached: the inverse gives the training position in [0, 1].

    Equal rows are counted first and one place is cut among them, so a key that
    holds many rows is one row in the running totals. Null text: size 0, taken
    0. Null source: a source of its own, ranked last. Null doc_id: placed like
    the empty string. A source without words has target 0. Empty table: no
    rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id"), F.col("source"), word_count("text").alias("size"))
    rows = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"))
    rows = rows.withColumn("words", F.col("size") * F.col("rows"))
    rows = rows.withColumn("spot", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = stage(rows, "sizes")
    spans = block_count(rows.count())
    block = F.floor(F.conv(F.substring("spot", 1, 8), 16, 10).cast("double") * spans / 2.0**32).cast("long")
    rows = rows.withColumn("block", block)
    sources = rows.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = stage(with_targets(sources, weights, most), "targets")
    rows = running_total(rows, ["source"], "block", ["spot", "doc_id", "size"], "words", "before")
    rows = joined(rows, sources, ["source"])
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1))
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "rank", "before", each.alias("row"))
    rows = rows.withColumn("before", F.col("before") + F.col("row") * F.col("size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - passes * F.col("source_size")
    more = ((F.col("size") > 0) & (F.col("before") + F.col("size") / 2.0 <= rest)).cast("long")
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, passes + more).otherwise(0).cast("int"))
    kinds = len(schedules)

    def position(copy: Column) -> Column:
        share = (copy * F.col("source_size") + F.col("before") + F.col("size") / 2.0) / F.col("target")
        share = F.least(F.lit(1.0), share)
        out = time_of(share, schedules[0])
        for kind in range(1, kinds):
            out = F.when(F.col("rank") % kinds == kind, time_of(share, schedules[kind])).otherwise(out)
        return out

    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>"))
    return rows.select(
        "doc_id",
        "source",
        "size",
        "row",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
        F.transform(copies, position).alias("positions"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, sorted by training position.

    Rows that share doc_id, source and size take part with their own texts:
    they get the key's places in the order of their digests, so the same table
    gives the same order however it is partitioned. Equal rows are one row with
    a number of copies; the copies are numbered through running totals in
    blocks, never by a window over a whole key.
    """
    planned = stage(plan(docs, **options), "mix-plan")
    keys = ["mix_id", "mix_source", "mix_size"]
    taken = planned.select(
        F.col("doc_id").alias("mix_id"),
        F.col("source").alias("mix_source"),
        F.col("size").alias("mix_size"),
        F.col("row").alias("mix_no"),
        F.col("positions").alias("mix_positions"),
    )
    rows = docs.select(F.struct(*docs.columns).alias("mix_row"))
    rows = rows.select("mix_row", F.col("mix_row.doc_id").alias("mix_id"), F.col("mix_row.source").alias("mix_source"))
    rows = rows.withColumn("mix_size", word_count("mix_row.text"))
    order = ["mix_position", "mix_id", "mix_source", "mix_size"]
    if not taken.where("mix_no > 0").isEmpty():
        rows = rows.withColumn("mix_digest", F.sha2(F.to_json("mix_row", {"ignoreNullFields": "false"}), 256))
        own = [*keys, "mix_digest"]
        copies = stage(rows.groupBy(*own).agg(F.count(F.lit(1)).alias("mix_rows")), "mix-copies")
        block = hash_block(F.xxhash64("mix_digest"), block_count(copies.count()))
        copies = running_total(copies.withColumn("mix_block", block), keys, "mix_block", ["mix_digest"], "mix_rows", "mix_before")
        number = F.explode(F.sequence(F.col("mix_before"), F.col("mix_before") + F.col("mix_rows") - 1))
        taken = joined(taken, copies.select(*own, number.alias("mix_no")), [*keys, "mix_no"])
        rows = rows.groupBy(*own).agg(F.first("mix_row").alias("mix_row"))
        keys, order = own, [*order, "mix_digest"]
    rows = joined(rows, taken.drop("mix_no"), keys).withColumn("mix_position", F.explode("mix_positions"))
    return rows.orderBy(*order).select("mix_row.*")
