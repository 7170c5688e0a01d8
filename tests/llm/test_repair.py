import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from rivulet.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string, at string, seg string, code string, kind string, audit string"
WHITE = " \t\n\x0b\x0c\r"


def nonnull(value):
    return " " if value is None else value


def ordered(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest())
    return sorted(rows, key=key)


def brute(conv_id, rows):
    """The result for one conversation, by trying every edit at every place."""
    rows = ordered([(c, t, nonnull(r), nonnull(x)) for c, t, r, x in rows])
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WHITE)
        if not bare:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    def follows(done, initial):
        return re.fullmatch(r"(s?(ua)*u?)?", done + initial)

    @lru_cache(None)
    def best(i, done, more_inserts=2):
        """(cost, audit, lines) from row i on; `done` are the last initials put out."""
        found = [(0, "", ())] if i == len(rows) and done[-1:] in ("", "a") else []
        for role in ("user", "assistant"):
            if more_inserts and follows(done, role[0]):
                c, a, lines = best(i, _short(done + role[0]), more_inserts - 1)
                found.append((c + 3, "I" + a, (role + ":",) + lines))
        if i < len(rows):
            c, a, lines = best(i + 1, done)
            found.append((c + 4, "D" + a, lines))
            role, text = rows[i][2:]
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                if role and follows(done, role[0]):
                    c, a, lines = best(i + 1, _short(done + role[0]))
                    found.append((c + more, "K" + a, (f"{role}:{text}",) + lines))
                for new in ("user", "assistant"):
                    if follows(done, new[0]):
                        c, a, lines = best(i + 1, _short(done + new[0]))
                        found.append((c + 3 + more, "R" + a, (f"{new}:{text}",) + lines))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = best(0, "")
    turns = [r[1] for r in rows if r[1] is not None]
    roles = [r[2][:1] for r in rows]
    return (
        conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def _short(done):
    """What the grammar needs to know of the initials so far."""
    return done if len(done) < 3 else done[-2:] if done[-1] == "a" else "u"


def want(rows, ids=()):
    groups = {c: [] for c in ids}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return sorted((brute(c, g) for c, g in groups.items()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], SCHEMA)


def got(spark, rows, segment):
    return sorted(map(tuple, R.repair(table(spark, rows), segment).collect()), key=str)


def random_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        size = rng.choice([1, 2, 3, 5, 9, 14])
        for turn in range(size):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", "u", None])
            text = rng.choice(["Yes.", "No!", "cut", "so on", "", " \t\n", None, f"own {turn}?", f"tail {turn}", "é. \n"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, text))
    return rows


@pytest.mark.parametrize("segment", [0, 1, 16])
def test_equals_brute_force(spark, segment):
    rows = random_rows(segment, 60)
    assert got(spark, rows, segment) == want(rows)


def test_one_long_conversation_in_segments(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["a.", f"b {t}.", f"c {t}", ""])) for t in range(260)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")] + [(3, 5, "user", "same.")] * 90
    assert got(spark, rows, 2) == want(rows)


def test_least_audits_against_all_paths():
    rng = random.Random(4)
    costs = R.Costs()
    for _ in range(150):
        codes = np.array([rng.randrange(16) for _ in range(rng.randrange(1, 7))])
        total, bits = costs.back(codes, R._END)
        arcs = np.array([b >> 4 * s & 15 for b in bits for s in range(4)] + list(R._END_ARCS))
        audits, ends = R.least_audits(arcs, np.append(codes // 4, 0), np.arange(4))

        def paths(node):
            if arcs[node] == 0:
                yield ""
            place, state = divmod(node, 4)
            for k, letter in enumerate("DIKR"):
                if arcs[node] >> k & 1:
                    to = {"D": state, "K": codes[place] // 4 + 1 if place < len(codes) else 0}.get(letter, R._STEP[state])
                    for rest in paths(4 * (place + (letter != "I")) + to):
                        yield letter + rest

        assert audits == [min(paths(s)) for s in range(4)]
        assert all(e // 4 == len(codes) for e in ends)


def test_damage_and_empty_conversations(spark):
    rows = random_rows(77, 80)
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{nonnull(conv)}:{nonnull(turn)}".encode()) % 20
        role, text = nonnull(role), nonnull(text)
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    frame = table(spark, rows)
    found = sorted(map(tuple, R.repair_all(frame, R.damaged(frame), 1).collect()), key=str)
    ids = {r[0] for r in rows}
    assert len(out) != len(rows) and found == want(out, ids)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in found


def test_empty(spark):
    assert R.repair(table(spark, [])).count() == 0
    none = table(spark, [])
    assert R.repair_all(none, R.damaged(none)).count() == 0
