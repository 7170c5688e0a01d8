"""Sequential models that the operators are compared with."""

from __future__ import annotations


class Duplicate(Exception):
    pass


def replay_rows(base, changes, modes):
    """`base` maps key -> row tuple; changes are (seq, op, row, old), keyed by row[0]."""
    state = dict(base)
    for _, op, row, old in sorted(changes, key=lambda c: c[0]):
        key = row[0]
        live = state.get(key)
        if op == "insert":
            if modes.imode == "replace" or live is None:
                state[key] = row
            elif modes.imode == "native":
                raise Duplicate(key)
        elif op == "update":
            if modes.umode == "native" and old is not None and old[0] != key:
                before = state.get(old[0])
                if before is not None and (modes.match == "key" or before == old):
                    if live is not None:
                        raise Duplicate(key)
                    del state[old[0]]
                    state[key] = row
            elif modes.umode == "replace":
                state[key] = row
            elif modes.match == "key":
                if live is not None:
                    state[key] = row
            elif live is not None and live == old:
                state[key] = row
        elif modes.dmode == "native":
            if modes.match == "key" or live == row:
                state.pop(key, None)
    return state


def replay_documents(base, changes):
    state = {k: dict(v) for k, v in base.items()}
    for _, op, key, doc in sorted(changes, key=lambda c: c[0]):
        if op == "delete":
            state.pop(key, None)
        else:
            state.setdefault(key, {}).update(doc or {})
    return state


def replay_gate(events, stored=None):
    """Keep events (seq, table, ts) that are not before the last accepted one."""
    last = dict(stored or {})
    kept = []
    for seq, table, ts in sorted(events):
        if table in last and ts < last[table]:
            continue
        last[table] = ts
        kept.append((seq, table, ts))
    return kept


def replay_batches(flags, size):
    """Batch and part of each row; a flagged row ends its batch."""
    batch, position, out = 0, 0, []
    for flag in flags:
        out.append((batch, position // size))
        position += 1
        if flag:
            batch, position = batch + 1, 0
    return out


def replay_runs(statements, size, merges):
    run, position, out = -1, 0, []
    before = None
    for statement in statements:
        if run >= 0 and statement == before and merges(statement):
            position += 1
        else:
            run, position = run + 1, 0
        out.append((run, position // size))
        before = statement
    return out
