"""The registered queries of this subpackage and their SQL checks, by module."""

from __future__ import annotations

from pyspark import cloudpickle

from . import alignment, dedup, neighbours, packing, periodic, plans_native, plans_rules, plans_text, private, quality, substrings, words

# Functions that run in tasks travel with the plan, so executors need not have this package installed.
for module in (words, alignment, dedup, neighbours, packing, periodic, private, quality, substrings):
    cloudpickle.register_pickle_by_value(module)

QUERIES = plans_native.QUERIES | plans_rules.QUERIES | plans_text.QUERIES
ORACLES = plans_native.ORACLES | plans_rules.ORACLES | plans_text.ORACLES
