"""Operators for large training corpora.

Nothing outside this subpackage imports it.  ``queries()`` and ``oracle_sql()``
collect what the modules register; the repository's entry file adds them when
this subpackage is there.
"""

from __future__ import annotations

from importlib import import_module

MODULES = ("decontaminate", "licenses", "tokencounts", "warc", "mixing", "substrings", "minhash", "secretscan", "chat", "quality")


def queries() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"{__name__}.{name}").QUERIES
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(import_module(f"{__name__}.{name}"), "ORACLES", {})
    return out
