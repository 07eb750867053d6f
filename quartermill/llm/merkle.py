"""A Merkle manifest of a table: a tree per source, a tree over the sources, and an inclusion proof for every row.

Leaves are numbered inside their source and cut into superblocks of FANOUT **
HEIGHT. A first pass reduces every superblock to its node; the few nodes above
are reduced level by level with plain grouping. Then the leaves of a superblock
are cogrouped with the outer nodes that it needs (its path to the root), and
one function finishes the local reduction, joins the proofs and folds them.
"""

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import numbered, placed, remainder
from quartermill.session import stage

#: Nodes of a run, and levels inside a superblock.
FANOUT, HEIGHT = 16, 2
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values one after another: ``-`` for null, else byte count, colon, value."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined_digest(nodes: list[bytes]) -> bytes:
    """SHA-256 of digests, concatenated as lowercase hex text."""
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


def reduction(nodes: list[bytes], levels: int | None, fanout: int = FANOUT) -> list[list[bytes]]:
    """All levels from ``nodes`` up: ``levels`` reductions, or with None until one node remains."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        last = out[-1]
        out.append([joined_digest(last[a : a + fanout]) for a in range(0, len(last), fanout)])
    return out


def _levels(rows: int, fanout: int) -> int:
    """Reductions until one of ``rows`` nodes remains."""
    levels = 0
    while rows > 1:
        rows, levels = -(-rows // fanout), levels + 1
    return levels


def climbed(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Reduces ``nodes`` (host, idx, node), numbered gapless inside ``host``: (host, idx, top, path) for each of them.

    ``path`` holds from the bottom to the top the run that the node's ancestor
    lies in and its place there. A run is one group of at most ``fanout`` rows,
    both on the way up and on the way down, however many nodes a host has.
    """
    sizes = nodes.groupBy("host").agg(F.max("idx").alias("last"))
    level = stage(nodes.join(sizes, "host").withColumn("n", F.col("last") + 1).drop("last"), "nodes")
    most = level.agg(F.max("n")).first()[0] or 0
    empty = F.expr("CAST(array() AS ARRAY<STRUCT<place: INT, nodes: ARRAY<BINARY>>>)")
    done, runs = [], []
    for _ in range(_levels(most, fanout)):
        done.append(level.where("n = 1").select("host", "idx", F.col("node").alias("top"), empty.alias("path")))
        grouped = level.where("n > 1").groupBy("host", "n", F.floor(F.col("idx") / fanout).alias("run"))
        members = F.transform(F.array_sort(F.collect_list(F.struct("idx", "node"))), lambda x: x["node"])
        runs.append(stage(grouped.agg(members.alias("nodes")), "runs"))
        text = F.lower(F.array_join(F.transform("nodes", lambda x: F.hex(x)), ""))
        above = F.ceil(F.col("n") / fanout).cast("long").alias("n")
        level = runs[-1].select("host", F.col("run").alias("idx"), F.unhex(F.sha2(text, 256)).alias("node"), above)
    found = level.select("host", "idx", F.col("node").alias("top"), empty.alias("path"))
    for run, tops in zip(reversed(runs), reversed(done)):
        parents = found.withColumnRenamed("idx", "run")
        below = run.select("host", "run", "nodes", F.explode(F.sequence(F.lit(0), F.size("nodes") - 1)).alias("place"))
        step = F.array(F.struct("place", "nodes"))
        below = parents.join(below, ["host", "run"]).select(
            "host", (F.col("run") * fanout + F.col("place")).alias("idx"), "top", F.concat(step, "path").alias("path")
        )
        found = below.unionByName(tops)
    return found


def leaves(docs: DataFrame, tampered: Column | None = None, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """doc_id, host (the source as an ordered key), leaf and used of every row, numbered ``idx`` from 0 inside its host.

    ``used`` is the leaf of the row with the A-Z of its text in lower case
    where ``tampered`` holds, else the leaf itself.
    """
    row = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")],
        F.col("n_chars").cast("long").alias("n_chars"),
    )
    changed = [F.translate(F.col(c), UPPER, LOWER) if c == "text" else F.col(c) for c in columns]
    leaf = leaf_digest([F.col(c) for c in columns])
    used = leaf if tampered is None else F.when(tampered, leaf_digest(changed)).otherwise(leaf)
    host = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), "source"))
    rows = row.select("doc_id", host.alias("host"), leaf.alias("leaf"), used.alias("used"))
    # The last key only splits equal rows over partitions.
    order = ["host", "doc_id", "leaf", "salt"]
    rows = rows.withColumn("salt", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    return numbered(placed(rows, "leaves"), "host", "idx").select("doc_id", "host", "idx", "leaf", "used")


def _reduced(levels: int, fanout: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx")
        top = reduction(frame["leaf"].tolist(), levels if frame["split"].iloc[0] else None, fanout)[-1][0]
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "idx": [frame["block"].iloc[0]], "node": [top]})

    return run


def _proved(levels: int, fanout: int, keep_proof: bool):
    """The cogroup of a superblock's leaves and its one row of outer nodes."""

    def run(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        own, used = block["leaf"].tolist(), block["used"].tolist()
        rings = reduction(own, levels if block["split"].iloc[0] else None, fanout)
        above = [(int(s["place"]), list(s["nodes"])) for s in outer["path"].iloc[0]]
        root = outer["root"].iloc[0]
        proofs, folds, lists = [], [], []
        for i, leaf in enumerate(used):
            steps = []
            at = i
            for ring in rings[:-1]:
                start = at - at % fanout
                steps.append((at % fanout, ring[start : start + fanout]))
                at //= fanout
            siblings, node = [], leaf
            for place, nodes in steps + above:
                siblings += nodes[:place] + nodes[place + 1 :]
                node = joined_digest([*nodes[:place], node, *nodes[place + 1 :]])
            proofs.append(joined_digest(siblings).hex())
            folds.append(node.hex())
            if keep_proof:
                lists.append([n.hex() for n in siblings])
        out = pd.DataFrame(
            {
                "doc_id": block["doc_id"],
                "leaf": [x.hex() for x in own],
                "subroot": outer["subroot"].iloc[0].hex(),
                "root": root.hex(),
                "proof_sha256": proofs,
                "folded_root": folds,
                "verified": [f == root.hex() for f in folds],
            }
        )
        if keep_proof:
            out["proof"] = pd.Series(lists, index=out.index)
        return out

    return run


def proved(
    docs: DataFrame, tampered: Column | None = None, fanout: int = FANOUT, height: int = HEIGHT, keep_proof: bool = False
) -> DataFrame:
    """A row for every row of ``docs``: its leaf, its source's subroot, the root, its proof and what the proof folds to.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of all siblings, level
    by level), folded_root (from the tampered leaf where ``tampered`` holds),
    verified, and with ``keep_proof`` the siblings themselves.

    Null values have a leaf value of their own; a null source is a source,
    before all others; null ids come first in a source. Rows of one id are
    ordered by their leaf, equal rows have equal leaves and proofs of their
    own. A lone leaf is its source's subroot; with no sibling at all the proof
    is the digest of nothing. Empty table: no rows. Other columns are ignored.
    """
    size = fanout**height
    rows = leaves(docs, tampered)
    rows = rows.withColumn("block", F.floor(F.col("idx") / size).cast("long"))
    split = rows.groupBy("host").agg((F.max("block") > 0).alias("split"))
    rows = stage(rows.join(split, "host"), "numbered-leaves")
    tops = rows.groupBy("host", "block").applyInPandas(_reduced(height, fanout), "host string, idx long, node binary")
    inner = stage(climbed(tops, fanout), "superblocks")
    subroots = inner.where("idx = 0").select("host", F.col("top").alias("node"))
    ordered = numbered(placed(subroots.repartitionByRange("host").sortWithinPartitions("host").withColumn("all", F.lit("")), "subroots"), "all", "idx")
    ordered = stage(ordered.select("host", "idx", "node"), "sources")
    over = climbed(ordered.select(F.lit("").alias("host"), "idx", "node"), fanout).drop("host")
    over = over.join(ordered, "idx").select("host", F.col("top").alias("root"), F.col("path").alias("over"))
    outer = inner.join(over, "host").select(
        "host", F.col("idx").alias("block"), F.col("top").alias("subroot"), "root", F.concat("path", "over").alias("path")
    )
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if keep_proof:
        schema += ", proof array<string>"
    pairs = rows.groupBy("host", "block").cogroup(outer.groupBy("host", "block"))
    return pairs.applyInPandas(_proved(height, fanout, keep_proof), schema)


def fifth(key: str = "doc_id") -> Column:
    """Rows whose key's checksum is divisible by 5; a null key's is not."""
    return F.coalesce(remainder(key, 5) == 0, F.lit(False))
