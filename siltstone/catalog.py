"""Registered queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from siltstone.plans import contracts, corpus, files, queue, training

QUERIES = {**corpus.QUERIES, **training.QUERIES, **queue.QUERIES, **contracts.QUERIES, **files.QUERIES}
ORACLE_SQL = {**corpus.ORACLE_SQL, **training.ORACLE_SQL, **queue.ORACLE_SQL, **contracts.ORACLE_SQL, **files.ORACLE_SQL}
