"""Results that a worker process makes once, though the functions that ask for them come anew with each task."""

from __future__ import annotations

import sys
import types

STORE = "_glyphmill_tables"


def once(make):
    """Keeps a function's results by its name and arguments, for as long as the process lives."""
    name = make.__name__

    def get(*args):
        store = sys.modules.setdefault(STORE, types.ModuleType(STORE)).__dict__
        key = f"{name}{args!r}"
        if key not in store:
            store[key] = make(*args)
        return store[key]

    get.__name__, get.__doc__ = name, make.__doc__
    return get
