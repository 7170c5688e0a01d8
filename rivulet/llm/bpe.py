"""Byte-level BPE as a streaming transducer, and its decoder as a byte-to-text machine.

A merge list has a sufficient lookahead. Two texts that agree up to some point can only be
cut differently before it if a merge (s, w) across a boundary happens in one of them and
not in the other. `s` then lies on the right spine of the token that ends at the boundary,
the merge ranks before the one that takes `s` into that token, and `w` is itself missing in
one of the texts, for the same reason further right and by a merge of a lower rank still.
Ranks fall along such a chain, so its longest sum of `w` lengths is finite; `lookahead`
gives it for every token. A token followed by that many bytes is stable: it is emitted, and
what follows is encoded as if it began there. The encoder keeps one window of a piece,
however long the piece is, and the decoder keeps an unfinished character.

Texts are cut into pieces as byte-level tokenizers do it; the character classes are those
of the tokenizers library, asked once, since they depend on a Unicode version.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import parts

_WINDOW = 1024
_SLICE = 1 << 16
_SHORT = 48
# Pieces that a Python worker keeps: about 100 MB.
_CACHE, _CACHED_CHARS = 1 << 19, 48


def _alphabet() -> dict[str, int]:
    """The characters that stand for bytes: printable ones themselves, others from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {chr(b if b in kept else next(others)): b for b in range(256)}


def tables(definition: str) -> dict:
    """What encoding and decoding need of a tokenizer's JSON, as plain values.

    The merge list must be proper: every token is made by one merge, of tokens made before.
    """
    whole = json.loads(definition)
    model, pre = whole["model"], whole["pre_tokenizer"] or {}
    byte = _alphabet()
    off = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    if (
        model["type"] != "BPE" or pre.get("type") != "ByteLevel" or whole["normalizer"]
        or pre.get("add_prefix_space") or not pre.get("use_regex", True)
        or whole["post_processor"] or (whole["decoder"] or {}).get("type") != "ByteLevel"
        or any(model.get(k) for k in off)
    ):
        raise ValueError("only plain byte-level BPE is supported")
    vocab: dict[str, int] = model["vocab"]
    texts = {i: bytes(byte[c] for c in t) for t, i in vocab.items()}
    base = [0] * 256
    for char, b in byte.items():
        base[b] = vocab[char]
    ranks: dict[tuple[int, int], int] = {}
    made: list[int] = []
    spine: dict[int, tuple[int, int]] = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        left, right, token = vocab[a], vocab[b], vocab[a + b]
        if token in spine or any(len(texts[x]) > 1 and x not in spine for x in (left, right)):
            raise ValueError(f"merge {rank} makes a token anew or of parts not made yet")
        spine[token] = (right, rank)
        ranks[left, right] = rank
        made.append(token)
    special: dict[str, int] = {}
    for token in whole["added_tokens"]:
        if any(token.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must match as they are")
        special[token["content"]] = token["id"]
        texts[token["id"]] = token["content"].encode()
    return {
        "base": base, "ranks": ranks, "made": made, "bytes": texts, "special": special,
        "lookahead": _lookaheads(ranks, spine, texts), "classes": _classes(), "cache": {},
    }


def _lookaheads(ranks: dict, spine: dict, texts: dict[int, bytes]) -> dict[int, int]:
    """Bytes after each token's end that decide whether it is a token of the result."""
    known: dict[int, list[int]] = {}
    longest: dict[int, list[int]] = {}

    def reach(token: int, before: int) -> int:
        far = 0
        while True:
            n = bisect_left(known.get(token, ()), before)
            if n:
                far = max(far, longest[token][n - 1])
            if token not in spine:
                return far
            token, before = spine[token]

    for (left, right), rank in ranks.items():
        far = len(texts[right]) + reach(right, rank)
        known.setdefault(left, []).append(rank)
        so_far = longest.setdefault(left, [])
        so_far.append(max(far, so_far[-1] if so_far else 0))
    return {token: reach(token, len(ranks)) for token in texts}


class Merges:
    """Encodes whole pieces by merging the pair of the least rank, leftmost first."""

    def __init__(self, known: dict):
        self.base, self.ranks, self.made = known["base"], known["ranks"], known["made"]
        self.bytes, self.lookahead = known["bytes"], known["lookahead"]

    def encode(self, data: bytes) -> list[int]:
        ids = [self.base[b] for b in data]
        if len(ids) > _SHORT:
            return self._long(ids)
        get, none = self.ranks.get, len(self.made)
        found = [get(pair, none) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            ids[i] = token = self.made[best]
            del ids[i + 1]
            if i:
                found[i - 1] = get((ids[i - 1], token), none)
            if i + 1 < len(ids):
                found[i] = get((token, ids[i + 1]), none)
                del found[i + 1]
            else:
                del found[i]
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs, for many bytes."""
        end, get = len(ids), self.ranks.get
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = []

        def offer(i: int, j: int) -> None:
            rank = get((ids[i], ids[j]))
            if rank is not None:
                heapq.heappush(heap, (rank, i))

        for i in range(end - 1):
            offer(i, i + 1)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= end or get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = j = after[j]
            if j < end:
                before[j] = i
                offer(i, j)
            if before[i] >= 0:
                offer(before[i], i)
        return [x for x in ids if x >= 0]


class Transducer:
    """Encodes one piece that arrives bit by bit; holds a window of it at most."""

    def __init__(self, merges: Merges, window: int = _WINDOW):
        self.merges, self.held = merges, bytearray()
        self.window = window + max(merges.lookahead.values())

    def feed(self, data: bytes) -> list[int]:
        """Tokens that no further byte can change."""
        out: list[int] = []
        for at in range(0, len(data), self.window):
            self.held += data[at : at + self.window]
            if len(self.held) < self.window:
                continue
            done = 0
            for token in self.merges.encode(self.held):
                end = done + len(self.merges.bytes[token])
                if end + self.merges.lookahead[token] > len(self.held):
                    break
                out.append(token)
                done = end
            del self.held[:done]
        return out

    def finish(self) -> list[int]:
        out = self.merges.encode(self.held)
        self.held.clear()
        return out


def _classes() -> dict[str, str]:
    """Letters, numbers and white space as the library's expressions see them, as ranges."""
    from tokenizers import Regex, pre_tokenizers

    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, points))
    out = {}
    for name, kind in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s")):
        found = pre_tokenizers.Split(Regex(f"{kind}+"), "removed").pre_tokenize_str(text)
        ends, low = [], 0
        for _, (start, end) in found:  # what is left are the characters of other kinds
            if start > low:
                ends.append((low, start - 1))
            low = end
        if low < len(points):
            ends.append((low, len(points) - 1))
        # a run of places across the gap of surrogates is a run of characters as well
        out[name] = "".join(f"\\U{points[a]:08x}-\\U{points[b]:08x}" for a, b in ends)
    return out


class Pieces:
    """Cuts texts into pieces."""

    def __init__(self, classes: dict[str, str]):
        self.wide = self._cutter(*(classes[k] for k in "LNS"))
        # without characters beyond 0xFFFF, sets without them say the same, and faster
        self.plain = self._cutter(*(_below(classes[k]) for k in "LNS"))
        l, n, s = (classes[k] for k in "LNS")
        self.runs = [re.compile(f"[{x}]+") for x in (l, n, f"^{s}{l}{n}", s)]

    @staticmethod
    def _cutter(l: str, n: str, s: str):
        return re.compile(
            f"'(?:[stmd]|re|ve|ll)| ?[{l}]+| ?[{n}]+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+"
        ).findall

    def cut(self, text: str) -> list[str]:
        plain = text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)
        return self.plain(text) if plain else self.wide(text)


def _below(ranges: str) -> str:
    """The ranges of a class without the characters beyond 0xFFFF."""
    both = re.findall(r"\\U(\w{8})-\\U(\w{8})", ranges)
    kept = [(a, min(b, "0000ffff")) for a, b in both if a <= "0000ffff"]
    return "".join(f"\\U{a}-\\U{b}" for a, b in kept)


class Encoder:
    """Token ids of texts, in parts of a bounded number of characters."""

    def __init__(self, known: dict, size: int = _SLICE, window: int = _WINDOW):
        self.merges, self.pieces = Merges(known), Pieces(known["classes"])
        self.size, self.window = max(size, 8), window
        self.added, self.cache = known["special"], known["cache"]
        longest = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def ids(self, text: str) -> Iterator[bytes]:
        """Parts of the text's ids, as the bytes of 32-bit integers."""
        if self.special is None or not self.special.search(text):
            yield from self._plain(text)
            return
        for k, part in enumerate(self.special.split(text)):
            if k % 2:
                yield array("i", [self.added[part]]).tobytes()
            else:
                yield from self._plain(part)

    def _ids(self, pieces: list[str]) -> bytes:
        found = list(map(self.cache.get, pieces))
        if None in found:
            found = [self._piece(p) if ids is None else ids for p, ids in zip(pieces, found)]
        return b"".join(found)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that is not in the cache; a full cache begins anew."""
        if len(piece) > self.window:
            return b"".join(self._stream([piece]))
        ids = array("i", self.merges.encode(piece.encode())).tobytes()
        if len(piece) <= _CACHED_CHARS:
            if len(self.cache) >= _CACHE:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def _stream(self, texts) -> Iterator[bytes]:
        """Ids of one piece that arrives in several texts."""
        machine = Transducer(self.merges, self.window)
        for text in texts:
            yield array("i", machine.feed(text.encode())).tobytes()
        yield array("i", machine.finish()).tobytes()

    def _plain(self, text: str) -> Iterator[bytes]:
        at = 0
        while len(text) - at > self.size:
            part = text[at : at + self.size]
            pieces, end = self.pieces.cut(part), len(part)
            # a piece is decided by its own characters and two more
            while pieces and end > len(part) - 3:
                end -= len(pieces[-1])
                last = pieces.pop()
            if pieces:
                yield self._ids(pieces)
                at += end
            elif len(last) < len(part):
                yield self._ids([last])
                at += len(last)
            else:
                run = _Run(text, at, self.size, self.pieces.runs)
                yield from self._stream(run)
                at = run.end
        yield self._ids(self.pieces.cut(text[at:]))


class _Run:
    """A piece that fills the slice at `at`, in slices; then `end` is where it ends."""

    def __init__(self, text: str, at: int, size: int, kinds: list[re.Pattern]):
        self.text, self.end, self.size = text, at, size
        self.kind = next(k for k in kinds if k.match(text[at + size - 1]))
        self.white = self.kind is kinds[-1]

    def __iter__(self) -> Iterator[str]:
        at, high = self.end, self.end + self.size
        while True:
            open_ = high < len(self.text)
            # of white space the last character may belong to the next piece
            low = high - 1 if self.white and open_ else high
            yield self.text[at:low]
            self.end = at = low
            if not open_:
                return
            more = self.kind.match(self.text[high : high + self.size])
            if more is None:
                return
            high += more.end()


class Decoder:
    """Text of token ids that arrive bit by bit; holds an unfinished character at most."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.machine.decode(b"".join(map(self.table.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


def encode_texts(docs: DataFrame, definition: str) -> DataFrame:
    """(doc_id, ids) of every row: the ids of its whole text.

    `docs` needs doc_id and text; other columns are not looked at. `definition` is the JSON
    of a byte-level BPE tokenizer; another kind raises ValueError. Ids are those of the
    tokenizers library without special tokens around the text; the strings of added tokens
    inside a text become these tokens, nothing is truncated or padded. A null text counts
    as the empty one, without ids. Rows without doc_id and repeated rows are rows like any
    others. An empty table gives an empty result. No rows move between tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tables(definition))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in parts(batch):
                found, ends = [], [0]
                for text in part.column("text"):
                    ids = b"".join(encoder.ids(text.as_py() or ""))
                    found.append(ids)
                    ends.append(ends[-1] + len(ids) // 4)
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode_ids(encoded: DataFrame, definition: str) -> DataFrame:
    """(doc_id, ids, text) of rows with doc_id and ids: the text the ids stand for.

    Added tokens give their strings; bytes that are no UTF-8 become the replacement
    character. Null ids give the empty text and a null id gives nothing; an id that the
    tokenizer does not have gives nothing either, as in the tokenizers library.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(tables(definition)["bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        table = [known.get(i, b"") for i in range(max(known, default=-1) + 1)]
        for batch in batches:
            texts = []
            for row in batch.column("ids"):
                decoder, text = Decoder(table), []
                ids = pc.fill_null(row.values, -1).to_numpy() if row.is_valid else np.zeros(0, np.int32)
                ids = ids[(ids >= 0) & (ids < len(table))]
                for at in range(0, len(ids), _SLICE):
                    text.append(decoder.feed(ids[at : at + _SLICE].tolist()))
                texts.append("".join(text) + decoder.finish())
            columns = [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
