"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from slabworks.llm import annforest, bpe, chat, decontam, langid, neardup, prefixtrie, quality, ranking, secrets, sharding, suffixdup, warczip

_MODULES = (langid, chat, suffixdup, quality, sharding, decontam, secrets, neardup, warczip, bpe, annforest, ranking, prefixtrie)


def queries() -> dict:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
