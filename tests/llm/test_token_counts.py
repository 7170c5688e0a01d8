import pytest

from rivulet.llm import token_counts as T
from rivulet.util import scratch_dir
from tests.llm.cases import awkward, awkward_rows


@pytest.fixture(scope="module")
def definition():
    public = pytest.importorskip("public_tokenizers")
    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def rows():
    return awkward_rows() + [(90, "<|endoftext|> inside <|endoftext|>", "x", "y", 1), (91, "日本語 🙂\u0000\n\n  x", "x", "y", 1)]


def want(definition):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    out = []
    for doc_id, text, *_ in rows():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > 512))
    return sorted(out, key=str)


def test_counts_and_cache(spark, definition, monkeypatch):
    cache = scratch_dir(spark, "cache")
    docs = awkward(spark, rows())
    found = T.count_tokens(docs, cache, definition)
    assert sorted(map(tuple, found.collect()), key=str) == want(definition)
    version = T.tokenizer_version(definition)
    stored = T.read_cache(spark, cache, version)
    assert stored.count() == stored.select("digest").distinct().count() == len({r[1] or "" for r in rows()})
    misses = []
    real = T.encode
    monkeypatch.setattr(T, "encode", lambda texts, d: misses.append(texts.count()) or real(texts, d))
    again = T.count_tokens(docs, cache, definition)
    assert misses == [0] and sorted(map(tuple, again.collect()), key=str) == want(definition)
    more = T.count_tokens(docs.unionByName(awkward(spark, [(99, "new text", "x", "y", 1)])), cache, definition)
    assert more.count() == len(rows()) + 1 and misses == [0, 1]
    assert T.tokenizer_version(definition + " ") != version


def test_empty(spark, definition):
    assert T.count_tokens(awkward(spark, []), scratch_dir(spark, "cache"), definition).count() == 0
