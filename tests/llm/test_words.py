import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.llm.common import parts
from rivulet.llm.words import Words, grams, long_grams
from tests.llm.cases import lower, words

TEXT = st.one_of(st.none(), st.text("aAbé \t\n\x0b\r\x1f Z", max_size=30))


@settings(deadline=None, max_examples=60)
@given(st.lists(TEXT, max_size=6))
def test_words_and_hashes(texts):
    found = Words(pa.array(texts, pa.string()))
    assert found.counts().tolist() == [len(words(t)) for t in texts]
    for low in (False, True):
        hashes = found.hashes(lower=low)
        flat = [w for t in texts for w in words(lower(t) if low else t)]
        assert len(hashes) == len(flat)
        assert len(set(hashes.tolist())) == len(set(flat))
        assert len(set(zip(hashes.tolist(), flat, strict=True))) == len(set(flat))


def test_grams_tell_sequences_apart():
    hashes = Words(pa.array(["a b c a b c b a c"])).hashes()
    for size in (1, 2, 3):
        runs = [tuple("abcabcbac"[i : i + size]) for i in range(9 - size + 1)]
        for found in (grams(hashes, size), *long_grams(hashes, size)):
            assert len(set(found.tolist())) == len(set(runs)) == len(set(zip(found.tolist(), runs, strict=True)))
    assert len(grams(hashes, 10)) == len(long_grams(hashes, 10)[0]) == 0


def test_parts_cover_a_batch_in_order():
    texts = ["a" * 10, None, "b" * 500, "", "c", "d" * 90, "e" * 20]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(7))], names=["text", "k"])
    cut = list(parts(batch, 100))
    assert [k for p in cut for k in p.column("k").to_pylist()] == list(range(7))
    assert len(cut) == 4 and np.all([p.num_rows for p in cut])
