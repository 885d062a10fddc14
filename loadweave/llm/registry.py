"""All corpus queries and their SQL, by name."""

from __future__ import annotations

from . import bytebpe, codebooks, decontaminate, exactdedup, language, licences, mtree, quality, secrets, simhash, suffixdedup, toxicity, whitening

_MODULES = (mtree, quality, suffixdedup, bytebpe, simhash, language, licences, decontaminate, toxicity, secrets, codebooks, exactdedup, whitening)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
