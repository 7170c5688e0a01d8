"""Conversation structure repair: the cheapest edits that give alternating roles.

Rows of a conversation are laid out in order by a range shuffle and cut into segments of
bounded size. A node is a row's place and the state of the role grammar there. A backward
dynamic program gives every node its least cost to go; a segment of a conversation that is
longer needs the costs at its end, which come from the (min, +) product of the segments
behind it. Arcs that keep to the cost are optimal, and a node has one arc a letter at most.
Nodes are ranked by their least audits of 1, 2, 4, ... letters: ranks and pointers of twice
the length follow from those of the length before, at the pointer. Final ranks tell which
audits are equal, and the doubled pointers spell each of them once.

Texts move once, to where their conversation's repair is hashed. That pass streams: a
conversation of any length takes one task, as its digest must, but only its audit in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import in_order, small
from rivulet.util import stage

_SPACE = " \t\n\x0b\x0c\r"
_SEGMENT = 16  # rows of a segment, as a power of two
_KEEP, _REROLE, _DELETE, _INSERT, _TRUNCATED = 0, 3, 4, 3, 3
# States: nothing yet, after a system role, after a user, after an assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STEP = [_USER, _USER, _ASSISTANT, _USER]  # of an inserted or rerolled row
_FROM = {0: [_START], 1: [_START, _SYSTEM, _ASSISTANT], 2: [_USER], 3: []}  # a kept initial
_LETTERS = b"DIKR"
_D, _I, _K, _R = range(4)
_NEVER = 1 << 40
_END = (0, 2 * _INSERT, _INSERT, 0)  # costs after the last row
_END_ARCS = (0, 1 << _I, 1 << _I, 0)
# Initials s, u, a, others; faults none, blank, duplicate, truncated.
_NONE, _BLANK, _DUPLICATE, _OPEN = range(4)


def _reduced(costs: list[int]) -> tuple[int, tuple[int, ...]]:
    least = min(costs)
    return least, tuple(min(c - least, _NEVER) if c < _NEVER else _NEVER for c in costs)


def step(after: tuple[int, ...], code: int) -> tuple[int, tuple[int, ...], int]:
    """Costs before a row of costs after it: the least, the rest above it, optimal arcs.

    `code` is 4 * initial + fault; arcs are four bits a state, in the order of letters.
    """
    initial, fault = divmod(code, 4)
    arcs = [[after[s] + _DELETE, _NEVER, _NEVER, _NEVER] for s in range(4)]
    if fault in (_NONE, _OPEN):
        more = _TRUNCATED if fault == _OPEN else 0
        for s in range(4):
            arcs[s][_R] = after[_STEP[s]] + _REROLE + more
        for s in _FROM[initial]:
            arcs[s][_K] = after[initial + 1] + _KEEP + more
    cost = [min(a) for a in arcs]
    cost[_USER], cost[_ASSISTANT] = (
        min(cost[_USER], cost[_ASSISTANT] + _INSERT), min(cost[_ASSISTANT], cost[_USER] + _INSERT),
    )
    cost = [min(c, cost[_USER] + _INSERT) if s < _USER else c for s, c in enumerate(cost)]
    bits = 0
    for s in range(4):
        arcs[s][_I] = cost[_STEP[s]] + _INSERT
        for letter in range(4):
            if arcs[s][letter] == cost[s] < _NEVER:
                bits |= 1 << (4 * s + letter)
    return *_reduced(cost), bits


class Costs:
    """The dynamic program over rows from the last to the first; steps are kept."""

    def __init__(self):
        self.known: dict = {}

    def back(self, codes: np.ndarray, after: tuple[int, ...]) -> tuple[list[int], list[int]]:
        """Costs before the first row, and the optimal arcs of every row's states."""
        total, costs = _reduced(list(after))
        bits = []
        for code in codes[::-1].tolist():
            found = self.known.get((costs, code))
            if found is None:
                found = self.known[costs, code] = step(costs, code)
            total += found[0]
            costs = found[1]
            bits.append(found[2])
        return [total + c if c < _NEVER else _NEVER for c in costs], bits[::-1]


def least_audits(
    arcs: np.ndarray, initials: np.ndarray, starts: np.ndarray
) -> tuple[list[str], np.ndarray]:
    """Least audits from the nodes `starts`, and the nodes at which they end.

    Node 4 * place + state; `arcs` are the bits of a node's optimal arcs, none at an end;
    `initials` are those of the row at a place.
    """
    nodes = np.arange(len(arcs))
    place, state = nodes // 4, nodes % 4
    step_ = np.array(_STEP)[state]
    # the least letter of a node, and where its arc leads
    letter = np.where(arcs == 0, -1, np.log2(np.maximum(arcs & -arcs, 1)).astype(np.int64))
    goes = np.where(letter == _I, place, place + 1)
    to = np.select([letter == _D, letter == _K], [state, initials[place] + 1], step_)
    pointer = np.where(letter < 0, nodes, 4 * goes + to)
    rank, length = letter + 1, (letter >= 0).astype(np.int64)
    pointers = []
    while True:
        pointers.append(pointer)
        if (pointer[pointer] == pointer).all():
            break
        length = length + length[pointer]
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
    _, first, same = np.unique(rank[starts], return_index=True, return_inverse=True)
    sizes = length[starts[first]]
    ends = np.cumsum(sizes)
    at = np.repeat(starts[first], sizes)
    t = np.arange(len(at)) - np.repeat(ends - sizes, sizes)
    for k, far in enumerate(pointers):
        at = np.where(t >> k & 1, far[at], at)
    spelled = np.frombuffer(_LETTERS, np.uint8)[letter[at]].tobytes().decode()
    audits = [spelled[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
    return [audits[k] for k in same.tolist()], pointer[starts]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by (conv_id, seg), cut so that no segment is in two."""
    held = None
    for batch in batches:
        rows = batch.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
        last = rows.iloc[-1] if len(rows) else None
        if last is None:
            continue
        conv = rows["conv_id"].isna() if pd.isna(last["conv_id"]) else (rows["conv_id"] == last["conv_id"]).fillna(False)
        open_ = (conv & (rows["seg"] == last["seg"])).to_numpy(bool)
        held = rows[open_].reset_index(drop=True)
        if not open_.all():
            yield rows[~open_]
    if held is not None and len(held):
        yield held


def _firsts(rows: pd.DataFrame) -> np.ndarray:
    conv, seg = rows["conv_id"], rows["seg"].to_numpy(np.int64)
    number, absent = conv.fillna(0).to_numpy(np.int64), conv.isna().to_numpy(bool)
    new = np.ones(len(rows), bool)
    new[1:] = (number[1:] != number[:-1]) | (absent[1:] != absent[:-1]) | (seg[1:] != seg[:-1])
    return np.flatnonzero(new)


def _conv_ids(rows: pd.DataFrame, firsts: np.ndarray) -> pa.Array:
    return pa.array(rows["conv_id"].iloc[firsts], pa.int64(), from_pandas=True)


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every segment the costs from each state at its begin to each state at its end."""
    costs = Costs()
    for rows in _segments(batches):
        firsts, codes = _firsts(rows), rows["code"].to_numpy(np.int64)
        found = []
        for low, high in zip(firsts, [*firsts[1:], len(rows)]):
            ends = [tuple(0 if s == e else _NEVER for s in range(4)) for e in range(4)]
            columns = [costs.back(codes[low:high], end)[0] for end in ends]
            found.append([columns[e][s] for s in range(4) for e in range(4)])
        yield pa.RecordBatch.from_arrays(
            [_conv_ids(rows, firsts), pa.array(rows["seg"].iloc[firsts].astype("int64")), pa.array(found, pa.list_(pa.int64()))],
            ["conv_id", "seg", "costs"],
        )


def _ends(rows: pd.DataFrame) -> pd.DataFrame:
    """Costs to go at the end of every segment of one conversation."""
    rows = rows.sort_values("seg", ascending=False)
    after, found = list(_END), []
    for product in rows["costs"]:
        found.append(after)
        after = [min(product[4 * s + e] + after[e] for e in range(4)) for s in range(4)]
    last = [k == 0 for k in range(len(rows))]
    return pd.DataFrame({"conv_id": rows["conv_id"], "seg": rows["seg"], "after": found, "last": last})


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits, costs and ends of every segment by the state at its begin."""
    costs = Costs()
    for rows in _segments(batches):
        firsts, codes = _firsts(rows), rows["code"].to_numpy(np.int64)
        highs = np.append(firsts[1:], len(rows))
        after, last = rows["after"].iloc[firsts], rows["last"].iloc[firsts]
        arcs, starts, paid, places, whole = [], [], [], [], []
        at = 0
        for low, high, end, final in zip(firsts, highs, after, last):
            alone = end is None
            total, bits = costs.back(codes[low:high], _END if alone else tuple(int(x) for x in end))
            arcs += [b >> 4 * s & 15 for b in bits for s in range(4)]
            arcs += _END_ARCS if alone or final else (0,) * 4
            states = [_START] if alone else range(4)
            starts += [at + s for s in states]
            paid.append([total[s] for s in states])
            whole.append(alone)
            places.append(at)
            at += 4 * (int(high - low) + 1)
        padded = np.insert(codes, highs, 0) // 4  # a place after each segment's last row
        audits, ends = least_audits(np.array(arcs), padded, np.array(starts))
        grouped, reached, k = [], [], 0
        for alone in whole:
            n = 1 if alone else 4
            grouped.append(audits[k : k + n])
            reached.append((ends[k : k + n] % 4).tolist())
            k += n
        initial = codes // 4
        inner = np.ones(max(len(codes) - 1, 0), bool)
        inner[firsts[1:] - 1] = False
        bad = np.zeros(len(codes) + 1, np.int64)
        bad[2:] = np.cumsum(inner & ~_legal(initial[:-1], initial[1:]))
        yield pa.RecordBatch.from_arrays(
            [
                _conv_ids(rows, firsts), pa.array(rows["seg"].iloc[firsts].astype("int64")),
                pa.array(grouped, pa.list_(pa.string())), pa.array(reached, pa.list_(pa.int32())),
                pa.array(paid, pa.list_(pa.int64())), pa.array(bad[highs] - bad[firsts + 1]),
                pa.array(initial[firsts], pa.int32()), pa.array(initial[highs - 1], pa.int32()),
            ],
            ["conv_id", "seg", "audits", "ends", "costs", "illegal", "head", "tail"],
        )


def _legal(a, b):
    """Whether initials may follow each other: su, ua, au."""
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


class _Repair:
    """One conversation's repair: first its segments, then its rows, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.state = conv_id, [], _START
        self.cost, self.illegal, self.tail = None, 0, None
        self.hash, self.at, self.role, self.begun = hashlib.sha256(), 0, _START, False

    def segment(self, audits, ends, costs, illegal, head, tail) -> None:
        self.cost = costs[_START] if self.cost is None else self.cost
        broken = self.tail is not None and not _legal(self.tail, head)
        self.illegal, self.tail = self.illegal + illegal + int(broken), tail
        self.audit.append(audits[self.state])
        self.state = ends[self.state]

    def _put(self, text: str) -> None:
        self.hash.update(("\n" + text if self.begun else text).encode())
        self.begun = True

    def _made(self) -> str:
        self.role = _STEP[self.role]
        return "user" if self.role == _USER else "assistant"

    def _inserts(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            self._put(self._made() + ":")
            self.at += 1

    @property
    def edits(self) -> str:
        if len(self.audit) > 1:
            self.audit = ["".join(self.audit)]
        return self.audit[0]

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.role = "sua".index(role[0]) + 1
            self._put(f"{role}:{text}")
        elif edit == "R":
            self._put(f"{self._made()}:{text}")

    def done(self) -> tuple:
        self._inserts()
        return self.conv_id, self.illegal, self.cost, self.edits, self.hash.hexdigest()


_DONE = ["conv_id", "illegal", "cost", "audit", "repaired_sha256"]


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs of conversations whose segments and rows come sorted."""
    now: _Repair | None = None
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if now is None or now.conv_id != row["conv_id"]:
                found += [now.done()] if now else []
                now = _Repair(row["conv_id"])
            if row["kind"] == 0:
                now.segment(*(row[c] for c in ("audits", "ends", "costs", "illegal", "head", "tail")))
            else:
                now.row(row["role"], row["text"])
        if found:
            yield _repairs(found)
    if now:
        yield _repairs([now.done()])


def _repairs(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], _DONE)


def _coded(rows: DataFrame, segment: int) -> DataFrame:
    """(conv_id, turn, at, seg, code) of all rows, in order, without their texts."""
    bare = F.btrim("text", F.lit(_SPACE))
    ends = bare.endswith(".") | bare.endswith("!") | bare.endswith("?")
    initial = F.substring("role", 1, 1)
    light = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        F.when(bare == "", _BLANK).when(ends, _NONE).otherwise(_OPEN).alias("fault"),
    )
    light = in_order(light, "conv_id", "turn", "role", "digest")
    # the first of equal rows is known by its place, so that many equal rows meet no key
    first = light.where(F.col("fault") != _BLANK).groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
    again = (F.col("fault") != _BLANK) & F.col("new").isNull()
    told = light.join(first.select("at", F.lit(True).alias("new")), "at", "left")
    fault = F.when(again, _DUPLICATE).otherwise(F.col("fault"))
    return stage(
        told.select(
            "conv_id", "turn", "at", F.shiftright("at", segment).alias("seg"),
            (4 * F.col("initial") + fault).alias("code"),
        ),
        "coded",
    )


def _by_segment(coded: DataFrame) -> DataFrame:
    return coded.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "at").drop("at")


def repair(rows: DataFrame, segment: int = _SEGMENT) -> DataFrame:
    """Faults and the cheapest repair of every conversation.

    `rows` has conv_id, turn, role and text, and is read from storage; other columns are
    not looked at. A conversation's rows are taken by turn (null first), rows of one turn
    by role and the SHA-256 of the text. Null roles and texts are one space.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256. A row's first fault counts: blank (nothing but ASCII white space),
    duplicate (role and text seen earlier), truncated (no `.!?` at the end). Keep costs 0,
    Rerole to user or assistant 3, Delete 4 (blank and duplicate rows must go), Insert of an
    empty user or assistant row 3; a truncated row that stays adds 3. The result's role
    initials match `(s?(ua)+)?`; of the cheapest audits the least by ASCII is taken.

    Defined cases: a null conv_id is a conversation like any other; null turns come first
    and make no gaps; other initials than s, u, a can be rerolled or deleted only. Repeated
    rows are duplicates. Segments of 2**`segment` rows at most are solved at a time, and a
    conversation may have any number of them. An empty table gives an empty result.
    """
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    )
    coded = _coded(rows, segment)
    long = coded.select("conv_id", "seg").distinct().groupBy("conv_id").count().where("count > 1")
    long = stage(long.select(F.col("conv_id").alias("long_id")), "long")
    in_long = coded.join(small(long), F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
    products = _by_segment(in_long.select("conv_id", "seg", "at", "code")).mapInArrow(
        _products, "conv_id long, seg long, costs array<long>"
    )
    ends = stage(
        products.groupBy("conv_id").applyInPandas(_ends, "conv_id long, seg long, after array<long>, last boolean"),
        "ends",
    )
    known = small(ends.withColumnsRenamed({"conv_id": "end_id", "seg": "end_seg"}))
    met = F.col("conv_id").eqNullSafe(F.col("end_id")) & (F.col("seg") == F.col("end_seg"))
    solved = _by_segment(
        coded.join(known, met, "left").select("conv_id", "seg", "at", "code", "after", "last")
    ).mapInArrow(
        _solve,
        "conv_id long, seg long, audits array<string>, ends array<int>, costs array<long>, illegal long, head int, tail int",
    )
    nothing = {"turn": "long", "role": "string", "digest": "binary", "text": "string"}
    pieces = solved.select(
        "conv_id", F.lit(0).alias("kind"), "seg", "audits", "ends", "costs", "illegal", "head", "tail",
        *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()),
    )
    texts = rows.select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text"
    )
    order = ["conv_id", "kind", "seg", "turn", "role", "digest"]
    repaired = (
        pieces.unionByName(texts, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*order)
        .mapInArrow(_hash, "conv_id long, illegal long, cost long, audit string, repaired_sha256 string")
    )
    fault = F.col("code") % 4
    counted = coded.groupBy(F.col("conv_id").alias("id")).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *(F.count_if(fault == k).alias(n) for k, n in ((_BLANK, "blank"), (_DUPLICATE, "duplicate"), (_OPEN, "truncated"))),
    )
    whole = repaired.join(counted, F.col("conv_id").eqNullSafe(F.col("id")))
    return whole.select(
        "conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the CRC-32 of `conv_id:turn` modulo 20, nulls one space.

    0 drops a row, 1 empties its text, 2 takes its `.!?`, 3 repeats it, 4 makes it a user's.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.concat(text("conv_id"), F.lit(":"), text("turn"))
    told = conversations.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    times = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    without = F.translate("text", ".!?", "")
    return told.select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, without).otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("_"),
    ).drop("_")


def repair_all(conversations: DataFrame, rows: DataFrame, segment: int = _SEGMENT) -> DataFrame:
    """`repair(rows)` with a row for every conversation of `conversations`.

    A conversation without rows has zeros, an empty audit and the digest of nothing.
    """
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = ids.join(repair(rows, segment), F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in zeros),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
