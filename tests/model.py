"""Brute-force replay of batches over Python dictionaries: the meaning of the change operators.

A row is a dict with ``k`` (key, may be None), ``v`` (payload) and ``g`` (scope); its hash is the
text of its values, NULLs skipped.
"""

from __future__ import annotations

OPEN = "open"


def content(row: dict) -> str:
    return "||".join(str(row[c]) for c in ("k", "v", "g") if row[c] is not None)


def scd1(table: dict, batch: list[dict], at) -> dict:
    table = dict(table)
    for row in batch:
        held = table.get(row["k"])
        if held is None or content(held) != content(row):
            table[row["k"]] = {**row, "at": at}
    return table


def fact(table: dict, batch: list[dict], at, deletes) -> dict:
    table = dict(table)
    for row in batch:
        held = table.get(row["k"])
        if held is None or content(held) != content(row):
            table[row["k"]] = {**row, "at": at, "gone": None}
        elif held["gone"] is not None:
            table[row["k"]] = {**held, "at": at, "gone": None}
    present = {r["k"] for r in batch}
    scope = {r["g"] for r in batch}
    for k, held in list(table.items()):
        if k not in present and held["gone"] is None and _deletable(held, deletes, scope):
            table[k] = {**held, "gone": at}
    return table


def scd2(versions: list[dict], batch: list[dict], at, deletes) -> list[dict]:
    """Versions carry ``start`` and ``end`` (OPEN for the current one)."""
    out = [dict(v) for v in versions]
    current = {v["k"]: v for v in out if v["end"] == OPEN}
    present = {r["k"] for r in batch}
    scope = {r["g"] for r in batch}
    for row in batch:
        held = current.get(row["k"])
        if held is not None and content(held) == content(row):
            continue
        if held is not None:
            held["end"] = at
        out.append({**row, "start": at, "end": OPEN})
    for k, held in current.items():
        if k not in present and _deletable(held, deletes, scope):
            held["end"] = at
    return out


def append(versions: list[dict], batch: list[dict], at) -> list[dict]:
    newest: dict = {}
    for v in versions:
        best = newest.setdefault(v["k"], [])
        if not best or v["start"] > best[0]["start"]:
            newest[v["k"]] = [v]
        elif v["start"] == best[0]["start"]:
            best.append(v)
    fresh = []
    for row in batch:
        if content(row) not in {content(v) for v in newest.get(row["k"], [])}:
            fresh.append({**row, "start": at})
    return versions + fresh


def _deletable(held: dict, deletes, scope: set) -> bool:
    if deletes == "none":
        return False
    return deletes == "full" or held["g"] in scope
