"""Homomorphic multiset fingerprints: sums of wide vectors hashed from paragraphs, in SQL functions only.

A paragraph is hashed to 189 bits. A fingerprint counts, for each bit, the
paragraphs that have it set, modulo 2 ** 20, and the paragraphs themselves. So
it depends neither on the paragraphs' order nor on how it was put together:
adding a paragraph's vector inserts it, subtracting it deletes it.

Three counts lie in one long, 21 bits apart; the free bit between them takes
the carry of a sum and lends to a difference, which is then cut off.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import placed

#: Counts of 20 bits, three in a long.
BITS, GAP, LANES = 20, 21, 3
#: 64-bit hashes of a paragraph, and the longs that hold the counts of one's lowest 63 bits.
HASHES, WORDS = 3, 21
#: The lowest bit of each lane of a long.
_ONES = sum(1 << GAP * lane for lane in range(LANES))
_FULL = _ONES * ((1 << BITS) - 1)
_GUARD = _ONES << BITS
#: A paragraph: up to 256 characters to the end of a line or a sentence, that end included; nothing of a text is left out.
PARAGRAPH = r"[^\n.!?]{0,256}[\n.!?]+|[^\n.!?]{1,256}"


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))


def vector(items: str) -> Column:
    """The fingerprint of the array of paragraphs ``items`` (a SQL expression): their number, then the packed counts of their hashes' bits.

    The hashes are bound to a lambda's variable, so that they are computed once for all longs.
    """
    shifts = ", ".join(str(LANES * n) for n in range(WORDS))
    # Three neighbouring bits of a hash, moved to the lowest bits of their lanes.
    spread = " | ".join(f"(shiftleft(shiftrightunsigned(h, s), {(GAP - 1) * lane}) & {1 << GAP * lane}L)" for lane in range(LANES))
    counts = f"transform(array({shifts}), s -> aggregate(hashes, 0L, (total, h) -> (total + ({spread})) & {_FULL}L))"
    bound = f"transform(array(transform({items}, p -> xxhash64(k, p))), hashes -> {counts})"
    numbers = ", ".join(str(n) for n in range(HASHES))
    return F.expr(f"concat(array(CAST(size({items}) AS BIGINT) & {(1 << BITS) - 1}L), flatten(flatten(transform(array({numbers}), k -> {bound}))))")


def inserted(fingerprint: Column, vector_: Column) -> Column:
    """The fingerprint of a multiset with the paragraphs of ``vector_`` added."""
    return F.zip_with(fingerprint, vector_, lambda a, b: (a + b).bitwiseAND(F.lit(_FULL)))


def deleted(fingerprint: Column, vector_: Column) -> Column:
    """The fingerprint of a multiset with the paragraphs of ``vector_`` taken away."""
    return F.zip_with(fingerprint, vector_, lambda a, b: (a.bitwiseOR(F.lit(_GUARD)) - b).bitwiseAND(F.lit(_FULL)))


def hexed(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the paragraphs shared, of those of both, as estimated from the signed counts; 1 only for equal fingerprints.

    Set less unset bits of a lane are a sum of a random sign a paragraph, so
    products over the lanes estimate products of the paragraphs' numbers
    (standard error about 0.07). Two fingerprints of no paragraph are alike.
    """

    def signed(x: Column, n: Column, lane: int) -> Column:
        ones = F.shiftrightunsigned(x, GAP * lane).bitwiseAND(F.lit((1 << BITS) - 1))
        return ((2 * ones - n + F.lit(3 << BITS - 1)).bitwiseAND(F.lit((1 << BITS) - 1)) - F.lit(1 << BITS - 1)).cast("double")

    def products(x: Column, y: Column) -> Column:
        """Of one long: the product of both, and the mean of their squares."""
        pairs = [(signed(x, F.get(a, F.lit(0)), lane), signed(y, F.get(b, F.lit(0)), lane)) for lane in range(LANES)]
        both, own = pairs[0][0] * pairs[0][1], pairs[0][0] * pairs[0][0] + pairs[0][1] * pairs[0][1]
        for p, q in pairs[1:]:
            both, own = both + p * q, own + p * p + q * q
        return F.struct(both.alias("both"), own.alias("own"))

    rest = [F.slice(v, 2, HASHES * WORDS) for v in (a, b)]
    zero = F.struct(F.lit(0.0).alias("both"), F.lit(0.0).alias("own"))
    total = F.aggregate(
        F.zip_with(rest[0], rest[1], products),
        zero,
        lambda acc, x: F.struct((acc["both"] + x["both"]).alias("both"), (acc["own"] + x["own"]).alias("own")),
        lambda acc: F.when(acc["own"] > 0, F.greatest(F.lit(0.0), 2.0 * acc["both"] / acc["own"])).otherwise(F.lit(0.0)),
    )
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(total, F.lit(1.0 - 2.0**-40)))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with their key (id_key, text_hash), whole text and fingerprint."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id_key"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("text_hash"),
        "text",
    )


def followers(keys: DataFrame) -> DataFrame:
    """Each distinct row of keys (doc_id, id_key, text_hash, ...) with ``next_id`` and ``next_hash``, the key after it; after the last: the first.

    Order: null ids first, then ascending; rows of one id by the hash of their
    text. Keys are range-partitioned; a window never holds more than one
    partition's keys, and only a row a partition goes to one task.
    """
    order = [F.col("doc_id").isNotNull(), F.col("doc_id"), F.col("text_hash")]
    ranged = keys.distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    rows = placed(ranged, "document-order")
    first = rows.groupBy("part").agg(F.min_by(F.struct("id_key", "text_hash"), "place").alias("first_key"))
    over = Window.orderBy("part")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = first.select("part", F.coalesce(F.lead("first_key").over(over), F.first("first_key").over(whole)).alias("after_part"))
    inside = Window.partitionBy("part").orderBy("place")
    rows = rows.withColumn("after", F.lead(F.struct("id_key", "text_hash")).over(inside)).join(first, "part")
    after = F.coalesce("after", "after_part")
    return rows.select(*keys.columns, after["id_key"].alias("next_id"), after["text_hash"].alias("next_hash"))


def compared(docs: DataFrame, share: int = 4) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text has its last floor(n_chars / ``share``) characters replaced
    by as many first ones (or all) of the next document. Its fingerprint is
    derived from the text's: paragraphs from the cut on are deleted, the new
    ones inserted.

    Returns doc_id, n_chars, edited (text), fingerprint and edited_fingerprint
    (arrays of longs), near_edited and near_next. Null text: empty, with the
    fingerprint of no paragraph. Null doc_id: before all others. Rows of one id
    with different texts follow each other by a hash of the text; rows equal in
    id and text count as one document, and each has its result. Empty table: no
    rows. A table of one document is followed by itself. Other columns are
    ignored.
    """
    # Ids come back with the keys, so both joins below read one shuffle of the texts and their vectors.
    keyed = fingerprinted(docs)
    order = followers(keyed.select("doc_id", "id_key", "text_hash", F.char_length("text").cast("long").alias("n_chars")))
    texts = keyed.withColumn("items", paragraphs(F.col("text"))).select("id_key", "text_hash", "text", vector("items").alias("vector"))
    # The columns aren't renamed below the join: then both sides have one plan, and their shuffle is reused.
    nexts, wanted = texts.alias("nexts"), order.toDF("doc_id", "to_key", "to_hash", "n_chars", "next_id", "next_hash")
    heads = wanted.join(nexts, F.expr("next_id = nexts.id_key AND next_hash = nexts.text_hash")).select(
        "doc_id",
        "to_key",
        "to_hash",
        "n_chars",
        F.col("nexts.vector").alias("next_vector"),
        F.substring("nexts.text", F.lit(1), F.floor(F.col("n_chars") / share).cast("int")).alias("head"),
    )
    counts = keyed.select("id_key", "text_hash").groupBy("id_key", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    if not counts.where("n > 1").isEmpty():  # each of the equal rows has found the one before
        heads = heads.dropDuplicates(["to_key", "to_hash"])
    rows = texts.join(heads, F.expr("id_key = to_key AND text_hash = to_hash")).withColumn("kept_chars", F.col("n_chars") - F.floor(F.col("n_chars") / share))
    rows = rows.withColumn("items", paragraphs(F.col("text"))).withColumn("whole", _whole(F.col("items"), F.col("kept_chars")))
    rest = F.substring("text", F.col("whole.start") + 1, (F.col("kept_chars") - F.col("whole.start")).cast("int"))
    gone = F.slice("items", F.col("whole.held") + 1, F.greatest(F.size("items"), F.lit(1)))
    rows = rows.withColumn("gone", gone).withColumn("come", paragraphs(F.concat(rest, F.col("head"))))
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.concat(F.substring("text", F.lit(1), F.col("kept_chars").cast("int")), F.col("head")).alias("edited"),
        F.col("vector").alias("fingerprint"),
        inserted(deleted(F.col("vector"), vector("gone")), vector("come")).alias("edited_fingerprint"),
        "next_vector",
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_vector")).alias("near_next"),
    )


def _whole(items: Column, limit: Column) -> Column:
    """Of paragraphs that end before ``limit`` characters: their number ``held``, and where the one after them starts.

    What follows such a paragraph's last character is kept as well, so it is a paragraph of the edited text too.
    """
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).alias("held"), F.lit(0).alias("start"))

    def step(acc: Column, item: Column) -> Column:
        end = acc["end"] + F.char_length(item)
        inside = end < limit
        return F.struct(
            end.alias("end"),
            F.when(inside, acc["held"] + 1).otherwise(acc["held"]).alias("held"),
            F.when(inside, end.cast("int")).otherwise(acc["start"]).alias("start"),
        )

    return F.aggregate(items, zero, step)
