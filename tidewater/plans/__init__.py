"""Registered queries over the driver tables, one module per family."""

import importlib

FAMILY_MODULES = [
    "tidewater.plans.readers",
    "tidewater.plans.graph",
    "tidewater.plans.auth",
    "tidewater.plans.triples",
    "tidewater.plans.corpus",
    "tidewater.plans.annotate",
    "tidewater.plans.text",
    "tidewater.plans.sketch",
    "tidewater.plans.vectors",
    "tidewater.plans.geo",
    "tidewater.plans.prep_eval",
    "tidewater.plans.trees",
    "tidewater.plans.ml",
]

_loaded = False


def load_all() -> None:
    global _loaded
    if _loaded:
        return
    for m in FAMILY_MODULES:
        importlib.import_module(m)
    _loaded = True
