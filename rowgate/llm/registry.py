"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from rowgate.llm import (
    collocations,
    decontamination,
    language,
    mixing,
    nn_descent,
    pieces,
    pseudonyms,
    repeats,
    sharding,
    spelling,
    url_reputation,
    warc,
    weighted_minhash,
)
from rowgate.llm.frames import shipped

_MODULES = (
    repeats, pseudonyms, warc, language, mixing, decontamination, sharding, nn_descent, url_reputation, weighted_minhash,
    collocations, pieces, spelling,
)

QUERIES = {name: shipped(run) for module in _MODULES for name, run in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
