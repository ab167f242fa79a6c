"""All registered queries and their oracle SQL."""

from __future__ import annotations

from checks import q_haplotypes, q_phase, q_relational, q_sources

QUERIES = {**q_sources.Q, **q_relational.Q, **q_haplotypes.Q, **q_phase.Q}
ORACLE = {**q_sources.SQL, **q_relational.SQL, **q_haplotypes.SQL, **q_phase.SQL}
