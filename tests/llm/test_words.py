"""Words and their hashes in whole Arrow batches."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quartermill.llm.textbatch import Words, blocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.none() | st.text(alphabet=st.sampled_from("ab \n\t\x0b\x00\x1fé漢😀Z"), max_size=40), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    found = Words(pa.array(texts, pa.string()))
    data = found.data.tobytes()
    words = [data[a:b].decode() for a, b in zip(found.starts, found.ends)]
    expected = [WORD.findall(t or "") for t in texts]
    assert words == [w for own in expected for w in own]
    assert found.counts.tolist() == [len(own) for own in expected]
    assert found.per_words(np.ones(len(words), np.int64)).tolist() == found.counts.tolist()
    hashes = found.hashes().tolist()
    assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))


def test_long_words_hash_by_all_bytes():
    base = "x" * 100
    words = [base, base + "y", *(base[:i] + "y" + base[i + 1 :] for i in range(100)), "xxxxxxxx", "xxxxxxx", "xxxxxxxxx"]
    hashes = Words(pa.array([" ".join(words)])).hashes()
    assert len(set(hashes.tolist())) == len(words)
    assert Words(pa.array([words[5]])).hashes()[0] == hashes[5]


def test_blocks_keep_all_rows_in_order():
    texts = ["a" * n for n in (5, 0, 900, 20, 3, 0, 0, 400)] + [None, "z"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], ["n", "text"])
    parts = list(blocks(iter([batch, batch.slice(3, 4)]), limit=100))
    assert [n for p in parts for n in p.column("n").to_pylist()] == [*range(10), 3, 4, 5, 6]
    assert len(parts) > 4
    assert list(blocks(iter([batch.slice(0, 0)]))) == []


def test_ngrams_are_counted_in_one_reading(monkeypatch):
    from collections import Counter

    from quartermill.llm import ngram_bloom as model

    texts = pa.array(["a b a b c", "", None, "c c d e", "a b", "e f g"])
    learnt = np.array([True, False, True, False, True, False])
    read = []
    tokens = model.tokens
    monkeypatch.setattr(model, "tokens", lambda words: read.append(1) or tokens(words))
    for marks in (learnt, ~learnt, np.ones(6, bool), np.zeros(6, bool)):
        for asked in (True, False):
            read.clear()
            got = model.counted_keys(texts, marks, asked)
            assert read == [1]
            stream, bounds = tokens(model.Words(texts, lower=True))
            mark = np.repeat(marks, np.diff(bounds))
            for (keys, counts), all_keys in zip(got, (stream, model.pairs(stream))):
                wanted = Counter(all_keys[mark].tolist())
                if asked:
                    wanted.update({k: 0 for k in all_keys.tolist()})
                assert keys.tolist() == sorted(wanted) and counts.tolist() == [wanted[k] for k in sorted(wanted)]
                assert counts.dtype == np.uint32 and keys.dtype == np.uint64
