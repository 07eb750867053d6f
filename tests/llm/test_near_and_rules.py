"""SimHash groups and line rules against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quartermill.llm import common, line_rules, mixture, quality_cnn, simhash
from tests.llm.data import PROSE, empty, hard, hard_rows, plain

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, distance=3):
    """Union of all near pairs by looking at every pair."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def expected_groups(rows):
    fps = [fingerprint(t) for _, t in rows]
    out, ids = [], defaultdict(list)
    found = roots(fps)
    for (doc, _), root in zip(rows, found):
        ids[root].append(doc)
    for (doc, _), fp, root in zip(rows, fps, found):
        known = [i for i in ids[root] if i is not None]
        out.append((doc, f"{fp:016x}", min(known) if known else None))
    return sorted(map(repr, out))


def groups_of(docs, **options):
    found = simhash.near_groups(docs, **options).select("doc_id", simhash.hexed("fp").alias("f"), "component_id")
    return sorted(repr(tuple(r)) for r in found.collect())


@pytest.mark.parametrize("bucket", [256, 1])
def test_groups_match_all_pairs(spark, bucket):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(r[0], r[1]) for r in hard_rows()]
    for n in range(12):
        words = list(rng.choice(vocabulary, 150))
        for copy in range(6):
            rows.append((100 * n + 11 + copy, " ".join(words)))
            words[int(rng.integers(0, 150))] = "changed"
    docs = plain(spark, [(i, t, "s") for i, t in rows])
    assert groups_of(docs, bucket=bucket) == expected_groups(rows)


def test_hard_rows_and_empty_table(spark):
    assert groups_of(hard(spark)) == expected_groups([(r[0], r[1]) for r in hard_rows()])
    assert groups_of(empty(spark)) == [] and simhash.keep_one(empty(spark)).count() == 0


@pytest.mark.parametrize("bucket", [1000, 2])
@pytest.mark.parametrize("segments", [2, 4])
def test_links_are_exactly_the_near_pairs(spark, bucket, segments):
    rng = np.random.default_rng(9)
    fps = {0, 1, 2**63, 2**64 - 1}
    for seed in rng.integers(0, 2**63, 12).tolist():
        for _ in range(25):
            fps.add(seed ^ sum(1 << int(b) for b in set(rng.integers(0, 64, int(rng.integers(0, 5))).tolist())))
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), segments=segments, bucket=bucket)
    got = {(r["a"] % 2**64, r["b"] % 2**64) for r in links.collect()}
    pairs = {(a, b) for a in signed for b in signed if a < b and (a % 2**64 ^ b % 2**64).bit_count() <= 3}
    assert got == {(a % 2**64, b % 2**64) for a, b in pairs}


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(1000, i) for i in range(1001, 1100)] + [(-5, -4), (-4, -5), (7, 7)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 1000 for i in range(1000, 1100)}, -5: -5, -4: -5}


def test_one_row_of_each_group_stays(spark):
    docs = hard(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r[0], r[1]) for r in hard_rows()]
    groups = roots([fingerprint(t) for _, t in rows])
    got = Counter(roots_of(groups, rows, [(r["doc_id"], r["text"]) for r in kept.collect()]))
    assert set(got) == set(groups) and set(got.values()) == {1}


def roots_of(groups, rows, kept):
    where = {row: g for row, g in zip(rows, groups)}
    return [where[k] for k in kept]


# --- line rules -----------------------------------------------------------------


def measured(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(inside)


def test_measures_of_hard_rows(spark):
    rows = [(r[0], r[1]) for r in hard_rows()] + [(77, "a b c\na b c\n a b c\n\n\na b c # | <x>", ), (78, "x y z x y z x y z x y z"), (79, "漢 字 漢 字 漢 字\n漢")]
    docs = plain(spark, [(i, t, "s") for i, t in rows])
    got = sorted(repr(tuple(r)) for r in line_rules.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    assert got == sorted(repr((i, *measured(t))) for i, t in rows)
    assert line_rules.judged(empty(spark)).count() == 0 and line_rules.filtered(empty(spark)).count() == 0
    assert line_rules.judged(hard(spark)).count() == len(hard_rows())


def page(n, words=60):
    return " ".join(f"w{n}x{i}" for i in range(words))


def test_common_lines_go_and_depleted_documents_with_them(spark):
    rows = [(i, f"{page(i)}\n  Shared   LINE here\nown {i}", "a") for i in range(30)]
    rows += [(100, page(100, 20) + "\n" + "\n".join(["shared line here"] * 12), "a")]
    # Copies of one text are one document: their lines are not common.
    rows += [(200 + i, f"{page(7777)}\nonly in the copies", "b") for i in range(50)]
    # The same line on another host, there in few documents.
    rows += [(300 + i, f"{page(300 + i)}\nshared line here", "c") for i in range(5)]
    docs = plain(spark, rows)
    verdicts = {r["doc_id"]: r for r in line_rules.judged(docs, share=0.1, least=8).collect()}
    assert all(verdicts[i]["lost_words"] == 3 and verdicts[i]["kept"] for i in range(30))
    assert verdicts[100]["lost_words"] == 36 and not verdicts[100]["kept"]
    assert all(verdicts[i]["lost_words"] == 0 and verdicts[i]["kept"] for i in [*range(200, 250), *range(300, 305)])
    kept = {r["doc_id"]: r for r in line_rules.filtered(docs, share=0.1, least=8).collect()}
    assert set(kept) == {r[0] for r in rows} - {100}
    assert kept[3]["text"] == f"{page(3)}\nown 3" and kept[3]["n_chars"] == len(kept[3]["text"])
    assert kept[301]["text"].endswith("shared line here")


def test_repeated_rows_lose_the_same_words(spark):
    rows = [(i, f"{page(i)}\nshared line here", "a") for i in range(30)]
    docs = plain(spark, rows + rows[:1] + rows[:1])
    got = [r["lost_words"] for r in line_rules.judged(docs, least=8).where("doc_id = 0").collect()]
    assert got == [3, 3, 3]
    assert line_rules.filtered(docs, least=8).where(F.col("doc_id") == 0).count() == 3


def test_null_source_is_a_host(spark):
    rows = [(i, f"{page(i)}\n{PROSE}", None) for i in range(20)]
    got = line_rules.judged(plain(spark, rows), least=8).collect()
    assert all(r["lost_words"] == len(PROSE.split()) for r in got)


def test_only_ascii_blanks_make_a_line_blank():
    common = [line_rules.line_hash("\u00a0".encode()), line_rules.line_hash("\u3000\u0085".encode())]
    assert line_rules.without("a\n\u00a0\n\x0b \n\u3000\u0085\nb\n", common) == "a\n\x0b \nb\n"


def test_stages_stand_columns_of_any_name(spark):
    names = ["lines", "quality_cnn_score", "row", "host", "text_key", "fold", "h", "c0", "common_lines", "mix_row", "mix_no"]
    docs = plain(spark, [(n, "\n".join([" ".join(f"w{n}x{k}{c}" for c in "abcde") for k in range(12)] + ["subscribe to our letter now"]), "s") for n in range(30)])
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    kept = line_rules.filtered(docs, depleted=0.9)
    assert kept.columns == docs.columns and kept.count() == 30
    assert {r[n] for r in kept.collect() for n in names} == set(names)
    assert all("subscribe" not in r["text"] and r["n_chars"] == len(r["text"]) for r in kept.collect())
    labels = spark.createDataFrame([(n, int(n % 2), 0) for n in range(30)], "doc_id long, quality int, toxic int")
    good = quality_cnn.accepted(docs, labels)
    assert good.columns == docs.columns and {r[n] for r in good.collect() for n in names} <= set(names)
    assert mixture.mix(docs).columns == docs.columns and mixture.mix(docs).count() == 30
