"""The registered queries: every operator on the shared tables, each with its SQL twin."""

from lakequeries import changes, columns, control, folds, ends

MODULES = (columns, changes, folds, control, ends)


def all_queries() -> dict:
    merged: dict = {}
    for module in MODULES:
        merged.update(module.QUERIES)
    return merged


def all_oracles() -> dict:
    merged: dict = {}
    for module in MODULES:
        merged.update(module.ORACLES)
    return merged
