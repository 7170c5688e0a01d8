import json
import random

import numpy as np
import pytest

from rivulet.llm import bpe as B
from rivulet.llm.queries import op12_bpe
from tests.llm.cases import awkward, awkward_rows

SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def definition():
    public = pytest.importorskip("public_tokenizers")
    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def known(definition):
    return B.tables(definition)


@pytest.fixture(scope="module")
def library(definition):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def ids(encoder, text):
    return np.frombuffer(b"".join(encoder.ids(text)), np.int32).tolist()


def texts(n):
    rng = random.Random(7)
    alphabet = "aab  bcd'sltrevem\n\t é日本ς1２Ⅷ!?,.  \x1c\x85😀\U0003fc36՘ǅ́"
    for k in range(n):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        if k % 5 == 0:
            text = text[:20] + SPECIAL * rng.randrange(1, 3) + text[20:]
        if k % 7 == 0:
            text += rng.choice("a !1日\n") * rng.randrange(1, 80) + text
        yield text


@pytest.mark.parametrize("size, window", [(8, 1), (16, 5), (B._SLICE, B._WINDOW)])
def test_equals_the_library_in_slices(known, library, size, window):
    encoder = B.Encoder(known, size, window)
    for text in texts(800):
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize(
    "text",
    ["x" * 200_000, "ab" * 50_000 + " " * 70_000 + "z", "日本" * 40_000 + "\n" * 70_000, "1!" * 40_000, "!" * 70_000 + "'re"],
    ids=["letters", "space", "wide", "mixed", "marks"],
)
def test_long_pieces(known, library, text):
    assert ids(B.Encoder(known), text) == library.encode(text, add_special_tokens=False).ids


def test_every_class_of_character(known, library):
    encoder = B.Encoder(known)
    for low in range(0, 0x110000, 0x8000):
        points = [p for p in range(low, low + 0x8000) if not 0xD800 <= p < 0xE000]
        text = "".join(map(chr, points))
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_transducer_holds_a_window_and_emits_what_is_stable(known):
    merges, rng = B.Merges(known), random.Random(3)
    most = max(known["lookahead"].values())
    for _ in range(60):
        data = "".join(rng.choice("abcdeghinorstu") for _ in range(rng.randrange(1, 900))).encode()
        machine, out, at = B.Transducer(merges, 4), [], 0
        while at < len(data):
            step = rng.randrange(1, 40)
            out += machine.feed(data[at : at + step])
            at += step
            assert len(machine.held) < 4 + most + 40
            # what is out is a beginning of the whole
            assert out == merges.encode(data)[: len(out)]
        assert out + machine.finish() == merges.encode(data)


def small_definition(pairs):
    alphabet = B._alphabet()
    vocab = {c: b for c, b in alphabet.items()}
    for a, b in pairs:
        vocab[a + b] = len(vocab)
    return json.dumps({
        "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "use_regex": True}, "post_processor": None,
        "decoder": {"type": "ByteLevel"}, "added_tokens": [],
        "model": {"type": "BPE", "vocab": vocab, "merges": [list(p) for p in pairs]},
    })


def test_lookahead_of_a_chain():
    # b a-chain: whether a b stay apart depends on b c, that on c d, that on d e
    known = B.tables(small_definition([("d", "e"), ("c", "d"), ("b", "c"), ("a", "b")]))
    far = {known["bytes"][t]: n for t, n in known["lookahead"].items() if n}
    assert far == {b"a": 4, b"b": 3, b"c": 2, b"d": 1, b"ab": 3, b"bc": 2, b"cd": 1}
    merges = B.Merges(known)
    cuts = {tail: [known["bytes"][t] for t in merges.encode(b"a" + tail)][0] for tail in (b"b", b"bc", b"bcd", b"bcde")}
    assert cuts == {b"b": b"ab", b"bc": b"a", b"bcd": b"ab", b"bcde": b"a"}


@pytest.mark.parametrize("seed", range(12))
def test_lookahead_suffices_for_random_lists(seed):
    rng, tokens, pairs = random.Random(seed), list("abc"), []
    while len(pairs) < 14:
        a, b = rng.choice(tokens), rng.choice(tokens)
        if a + b not in tokens and len(a + b) < 7:
            pairs.append((a, b))
            tokens.append(a + b)
    known = B.tables(small_definition(pairs))
    merges = B.Merges(known)
    for _ in range(300):
        data = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 80)))
        machine, out = B.Transducer(merges, 1), []
        for byte in data:
            out += machine.feed(bytes([byte]))
        assert out + machine.finish() == merges.encode(data)


def test_short_and_long_merging_agree(known, monkeypatch):
    merges, rng = B.Merges(known), random.Random(5)
    for _ in range(400):
        data = "".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(48))).encode()
        want = merges.encode(data)
        assert merges._long([merges.base[b] for b in data]) == want


def test_improper_lists_are_refused():
    with pytest.raises(ValueError):
        B.tables(small_definition([("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")]))


def test_decoder_keeps_unfinished_characters(known, library):
    table = [known["bytes"].get(i, b"") for i in range(50257)]
    rng = random.Random(2)
    for text in list(texts(60)) + ["é日本😀" * 9]:
        found, decoder, out = library.encode(text, add_special_tokens=False).ids, B.Decoder(table), ""
        for i in found:
            out += decoder.feed([i])
        assert out + decoder.finish() == text == library.decode(found, skip_special_tokens=False)
    for _ in range(200):
        wild = [rng.randrange(256) for _ in range(12)]
        decoder = B.Decoder(table)
        assert decoder.feed(wild) + decoder.finish() == library.decode(wild, skip_special_tokens=False)


def test_operators_on_awkward_rows(spark, definition, library):
    rows = awkward_rows() + [(90 + k, t, "x", "y", 1) for k, t in enumerate(texts(40))] + [(80, "z" * 70_000, "x", "y", 1)]
    encoded = B.encode_texts(awkward(spark, rows), definition)
    found = sorted(((r.doc_id, r.ids, r.text) for r in B.decode_ids(encoded, definition).collect()), key=str)
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in rows]
    assert found == sorted(want, key=str)
    assert B.decode_ids(B.encode_texts(awkward(spark, []), definition), definition).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [64, None, 10**6, -1, 65])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in B.decode_ids(odd, definition).collect()) == [(1, ""), (2, "ab")]


def test_query_equals_the_library(spark, library):
    import hashlib

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = set()
    for row in docs:
        found = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(found, skip_special_tokens=False)
        want.add((row.doc_id, len(found), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, found)), text))))
    assert {tuple(r) for r in op12_bpe(spark, sf_dir).collect()} == want
