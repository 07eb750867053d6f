"""Registered queries of the operators, with production parameters, over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.llm import (
    cover_tree,
    fill_middle,
    langid,
    line_rules,
    merkle,
    mixture,
    multiset_hash,
    ngram_bloom,
    packing,
    quality_cnn,
    sharding,
    simhash,
    toxicity,
)
from quartermill.llm.common import table

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixture.plan(table(spark, sf_dir, "documents"))
    rows = planned.select(
        "doc_id", "size", "source_size", "target", "taken", "copies", F.round(F.get("positions", F.lit(0)), 9).alias("position")
    )
    return rows.orderBy(F.col("position").asc_nulls_last(), "doc_id")


@query
def op2_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"), with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_rules.judged(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words"
    )


@query
def op5_cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, every_row=True)


@query
def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hexed("fp").alias("fingerprint"), "component_id")


@query
def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_piece_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


@query
def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


@query
def op10_bloom_ngram_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = ngram_bloom.trained_on(table(spark, sf_dir, "documents"))
    return ngram_bloom.scored(rows, "learnt", keep=("doc_id", "held_out"))


@query
def op11_secondary_sort_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digested(table(spark, sf_dir, "documents"))


@query
def op12_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = multiset_hash.compared(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        *[multiset_hash.hexed(F.col(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")],
        "near_edited",
        "near_next",
    )


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proved(table(spark, sf_dir, "documents"), merkle.fifth())


# --- SQL on DuckDB ------------------------------------------------------------
# Checksums, XXH64, networks, tokenizers, Bloom filters and piece models have no
# SQL there; their queries are tested against brute force or held-out labels.

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 bit by bit: each byte enters with the first of its eight steps.
_CRC32 = (
    "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length({0}) + 1), "
    "lambda i: [CAST(ascii(substr({0}, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END), 4294967295)"
)
_LEAF = " || ".join(
    f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')"
    for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{0}")
)
_SIDES = ", ".join(
    f"coalesce(string_agg(node, '') OVER (PARTITION BY {{0}} ORDER BY idx ROWS BETWEEN {rows}), '') AS {name}"
    for rows, name in (("UNBOUNDED PRECEDING AND 1 PRECEDING", "before"), ("1 FOLLOWING AND UNBOUNDED FOLLOWING", "after"))
)

ORACLES: dict[str, str] = {
    "op1_curriculum_mix": f"""
WITH sized AS (SELECT doc_id, source, CAST(len({_WORDS.format('text')}) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sources),
weighed AS (SELECT *, CASE place % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM ranked),
filled AS (SELECT *, ((SELECT sum(source_size) FROM weighed)::DOUBLE - coalesce(sum(3.0 * source_size) OVER before, 0)::DOUBLE)
    / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0)) AS share,
    row_number() OVER (ORDER BY 3.0 * source_size / weight, place) AS turn
  FROM weighed WINDOW before AS (ORDER BY 3.0 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT coalesce(arg_min(share, turn) FILTER (share * weight < 3.0 * source_size), 0) AS share FROM filled),
targets AS (SELECT w.source, w.source_size, w.place, CASE WHEN l.share * w.weight < 3.0 * w.source_size THEN l.share * w.weight ELSE (3.0 * w.source_size)::DOUBLE END AS target
  FROM weighed w, level l),
laid AS (SELECT d.*, t.source_size, t.place, t.target,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS earlier
  FROM sized d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source),
taken AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE floor(target / source_size)::INTEGER
    + (earlier + size / 2.0::DOUBLE <= target - floor(target / source_size) * source_size)::INTEGER END AS copies,
    least(1.0::DOUBLE, (earlier + size / 2.0::DOUBLE) / target) AS q FROM laid)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS INTEGER) AS copies,
  CASE WHEN copies > 0 THEN round(CASE place % 3 WHEN 0 THEN 2.0::DOUBLE * q / (1.5::DOUBLE + sqrt(2.25::DOUBLE - 2.0::DOUBLE * q)) WHEN 1 THEN q
    ELSE 2.0::DOUBLE * q / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0::DOUBLE * q)) END, 9) END AS position
FROM taken""",
    "op4_line_rules": rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, text, {_WORDS.format('text')} AS words FROM documents),
base AS (SELECT rid, doc_id, source, text, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM docs),
split AS (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS line FROM docs),
lines AS (SELECT *, {_WORDS.format('line')} AS parts FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
named AS (SELECT rid, source, text, line, len(parts) AS n, {_LOWER.format("array_to_string(parts, ' ')")} AS name FROM lines),
dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM docs GROUP BY source),
spread AS (SELECT source, name, count(DISTINCT text) AS holders FROM named GROUP BY source, name),
common AS (SELECT s.source, s.name FROM spread s JOIN hosts h ON h.source IS NOT DISTINCT FROM s.source
  WHERE s.holders > {line_rules.LEAST} AND s.holders > {line_rules.SHARE} * h.texts),
lost AS (SELECT l.rid, sum(l.n) AS n FROM named l JOIN common c ON c.source IS NOT DISTINCT FROM l.source AND c.name = l.name GROUP BY l.rid),
heads AS (SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM docs WHERE len(words) > 2),
grams AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n FROM heads),
repeats AS (SELECT rid, count(DISTINCT spot) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS spot FROM grams WHERE n > 1) GROUP BY rid),
found AS (SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols, CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(l.n, 0) AS BIGINT) AS lost_words
  FROM base b LEFT JOIN dups d USING (rid) LEFT JOIN repeats r USING (rid) LEFT JOIN lost l USING (rid)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM found)
SELECT *, NOT base_failed AND lost_words <= {line_rules.DEPLETED} * n_words AS kept FROM failed""",
    "op5_cover_tree_top_k": """
WITH fit AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM fit q JOIN fit c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10""",
    "op11_secondary_sort_fim": r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
drawn AS (SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda a: CAST('0x' || substr(h, a, 8) AS BIGINT)) AS r FROM docs),
formed AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS low, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS high,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain'
      WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(u[1:low], '') AS p, array_to_string(u[low + 1:high], '') AS m, array_to_string(u[high + 1:n], '') AS s FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS rid, doc_id, source, lang, n_chars, text,
    {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 AS tampered FROM documents),
rows AS (SELECT rid, doc_id, source, sha256({_LEAF.format('text')}) AS leaf,
    sha256(CASE WHEN tampered THEN {_LEAF.format(_LOWER.format('text'))} ELSE {_LEAF.format('text')} END) AS used FROM docs),
laid AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM rows),
up AS (SELECT source, 0 AS lvl, idx, leaf AS node, n FROM laid
  UNION ALL SELECT source, lvl + 1, idx // 16, sha256(string_agg(node, '' ORDER BY idx)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY source, lvl, idx // 16, n),
sides AS (SELECT source, lvl, idx, {_SIDES.format("source, lvl, idx // 16")} FROM up WHERE n > 1),
hosts AS (SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, idx, node, n FROM hosts
  UNION ALL SELECT lvl + 1, idx // 16, sha256(string_agg(node, '' ORDER BY idx)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY lvl, idx // 16, n),
over_sides AS (SELECT lvl, idx, {_SIDES.format("lvl, idx // 16")} FROM top WHERE n > 1),
fold AS (SELECT rid, source, 0 AS lvl, idx AS at, used AS node, '' AS proof FROM laid
  UNION ALL SELECT f.rid, f.source, f.lvl + 1, f.at // 16, sha256(s.before || f.node || s.after), f.proof || s.before || s.after
  FROM fold f JOIN sides s ON s.source IS NOT DISTINCT FROM f.source AND s.lvl = f.lvl AND s.idx = f.at),
inner_end AS (SELECT rid, arg_max(node, lvl) AS node, arg_max(proof, lvl) AS proof FROM fold GROUP BY rid),
over_fold AS (SELECT e.rid, 0 AS lvl, h.idx AS at, e.node, e.proof FROM inner_end e JOIN laid l USING (rid) JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source
  UNION ALL SELECT f.rid, f.lvl + 1, f.at // 16, sha256(s.before || f.node || s.after), f.proof || s.before || s.after
  FROM over_fold f JOIN over_sides s ON s.lvl = f.lvl AND s.idx = f.at),
ends AS (SELECT rid, arg_max(node, lvl) AS node, arg_max(proof, lvl) AS proof FROM over_fold GROUP BY rid)
SELECT l.doc_id, l.leaf, h.node AS subroot, t.node AS root, sha256(e.proof) AS proof_sha256, e.node AS folded_root, e.node = t.node AS verified
FROM laid l JOIN ends e USING (rid) JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source JOIN top t ON t.n = 1""",
}
