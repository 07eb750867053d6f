"""Fill-in-the-middle, multiset fingerprints and the Merkle manifest against brute force."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from tests.llm.data import empty, hard, plain

from quartermill.llm import fill_middle, merkle, multiset_hash

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def both(spark, sf_dir):
    """The hard rows, and a whole table."""
    return [hard(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")]


# --- fill in the middle -------------------------------------------------------


def fim(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[a : a + 8], 16) for a in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def test_fim_equals_brute_force(spark, sf_dir):
    marked = plain(spark, [(i, f"{'a ' * i}<{x}> and < P> or <P", "s") for i, x in enumerate("PSM" * 20)])
    for docs in [*both(spark, sf_dir), marked]:
        expected = [fim(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        expected = [(*r[:5], sha(r[5]), sha(r[6])) for r in expected]
        assert Counter(map(tuple, fill_middle.digested(docs).collect())) == Counter(expected)
    assert fill_middle.digested(empty(spark)).count() == 0


def test_fim_outputs_in_small_pieces(spark, monkeypatch):
    """Pieces of a few bytes cut units and characters; outputs and restored texts stay whole."""
    monkeypatch.setattr(fill_middle.cut, "__defaults__", (5,))
    docs = hard(spark).where("doc_id < 5 or doc_id > 5")
    expected = {(r[0], r[2], r[5]) for r in (fim(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())}
    found = defaultdict(list)
    for r in fill_middle.transformed(docs).collect():
        found[r.text_key, r.doc_id, r.form].append((r.place, bytes(r.piece)))
    texts = [(key[1], key[2], b"".join(p for _, p in sorted(pieces)).decode()) for key, pieces in found.items()]
    # A null and an empty text are two keys with one output.
    assert set(texts) == expected
    assert max(len(p) for pieces in found.values() for _, p in pieces) <= 8
    assert {r.restored_sha256 for r in fill_middle.digested(docs).collect()} == {sha(r.text or "") for r in docs.collect()}


def test_fim_rates(spark):
    docs = plain(spark, [(i, "a b c d", "s") for i in range(50)])
    assert {r.form for r in fill_middle.digested(docs, fim=0).collect()} == {"plain"}
    assert {r.form for r in fill_middle.digested(docs, fim=100, spm=0).collect()} == {"psm"}


# --- multiset fingerprints ----------------------------------------------------


def lanes(text):
    """The same fingerprint without packing."""
    counts, n = [0] * 189, 0
    for item in re.findall(multiset_hash.PARAGRAPH, text):
        n += 1
        for h in range(3):
            seed = xxhash.xxh64_intdigest(struct.pack("<i", h), 42)
            value = xxhash.xxh64_intdigest(item.encode(), seed)
            for b in range(63):
                counts[63 * h + b] += value >> b & 1
    return n, counts


def packed(text):
    n, counts = lanes(text)
    return [n, *[sum(counts[i + k] << 21 * k for k in range(3)) for i in range(0, 189, 3)]]


def alike(a, b):
    if packed(a) == packed(b):
        return 1.0
    (n, x), (m, y) = lanes(a), lanes(b)
    x, y = [2 * c - n for c in x], [2 * c - m for c in y]
    own = sum(v * v for v in x) + sum(v * v for v in y)
    return max(0.0, 2 * sum(v * w for v, w in zip(x, y)) / own) if own else 0.0


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def test_fingerprints_equal_brute_force(spark, sf_dir):
    for docs in both(spark, sf_dir):
        rows = {(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()}

        def order(row):
            key = xxhash.xxh64_intdigest(struct.pack("<i", int(row[0] is None)), xxhash.xxh64_intdigest(row[1].encode(), 42))
            return row[0] is not None, row[0] or 0, signed(key)

        rows = sorted(rows, key=order)
        after = {row: rows[(i + 1) % len(rows)][1] for i, row in enumerate(rows)}
        got = multiset_hash.compared(docs).collect()
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
        seen = defaultdict(set)
        for r in got:
            seen[r.doc_id].add((r.n_chars, r.edited, tuple(r.fingerprint), tuple(r.edited_fingerprint), round(r.near_edited, 9), round(r.near_next, 9)))
        expected = defaultdict(set)
        for (doc_id, text), following in after.items():
            k = len(text) // 4
            edited = text[: len(text) - k] + following[:k]
            near = round(alike(text, edited), 9), round(alike(text, following), 9)
            expected[doc_id].add((len(text), edited, tuple(packed(text)), tuple(packed(edited)), *near))
        assert seen == expected
    assert multiset_hash.compared(empty(spark)).count() == 0


def test_fingerprint_is_homomorphic(spark):
    frame = spark.createDataFrame([(["a", "b", "a"], ["b"], ["a", "a", "b"])], "x array<string>, y array<string>, z array<string>")
    x, y, z = (multiset_hash.vector(c) for c in "xyz")
    both_ways = multiset_hash.inserted(multiset_hash.deleted(x, y), y)
    row = frame.select(
        (x == z).alias("order"),
        (both_ways == x).alias("undone"),
        (multiset_hash.deleted(x, y) == x).alias("gone"),
        (multiset_hash.deleted(x, x) == multiset_hash.vector("array()")).alias("nothing"),
        multiset_hash.likeness(x, y).alias("part"),
    ).first()
    assert (row.order, row.undone, row.gone, row.nothing) == (True, True, False, True)
    assert 0 < row.part < 1
    modulo = (1 << 20) + 5  # more paragraphs than a lane counts
    many = spark.range(1).select(multiset_hash.vector(f"array_repeat('a', {modulo})").alias("v"), multiset_hash.vector("array_repeat('a', 5)").alias("w"))
    assert many.where("v = w").count() == 1


def test_fingerprints_use_native_functions_only(spark, sf_dir):
    plan = multiset_hash.compared(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- Merkle manifest ----------------------------------------------------------


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][a : a + 16])) for a in range(0, len(out[-1]), 16)])
    return out


def manifest(rows):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

    hosts = defaultdict(list)
    for r in rows:
        hosts[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    names = sorted(hosts, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(hosts[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    for place, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(hosts[s], key=lambda x: x[:3])):
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None
            node, siblings = leaf(r, r.text.translate(LOWER)) if tampered else own, []
            for levels, at in ((trees[s], i), (top, place)):
                for level in levels[:-1]:
                    run = level[at - at % 16 : at - at % 16 + 16]
                    siblings += run[: at % 16] + run[at % 16 + 1 :]
                    node = sha("".join([*run[: at % 16], node, *run[at % 16 + 1 :]]))
                    at //= 16
            yield r.doc_id, own, trees[s][-1][0], top[-1][0], sha("".join(siblings)), node, node == top[-1][0], tuple(siblings)


def proofs(docs, **options):
    return Counter((*r[:7], tuple(r.proof)) for r in merkle.proved(docs, merkle.fifth(), keep_proof=True, **options).collect())


@pytest.mark.parametrize("height", [1, 2])
def test_manifest_equals_brute_force(spark, sf_dir, height):
    for docs in both(spark, sf_dir):
        assert proofs(docs, height=height) == Counter(manifest(docs.collect()))


def test_manifest_of_many_and_of_lone_rows(spark):
    """A source of several levels above its superblocks, more sources than a run holds, and lone leaves."""
    rows = [(i, f"Text {i}", "big") for i in range(1100)] + [(i, "Same", f"s{i}") for i in range(40)] + [(7, None, None)] * 3
    docs = plain(spark, rows)
    assert proofs(docs, height=1) == Counter(manifest(docs.collect()))
    lone = plain(spark, [(1, "A", "x")])
    assert proofs(lone) == Counter(manifest(lone.collect()))
    assert merkle.proved(empty(spark), merkle.fifth()).count() == 0
