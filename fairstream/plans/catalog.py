"""All registered queries and their SQL oracles, in one place."""

from __future__ import annotations

from fairstream.plans import oracles as _oracles
from fairstream.plans import queries as _queries


def queries() -> dict:
    out = {}
    out.update(_queries.clustering_queries())
    out.update(_queries.fixed_start_queries())
    out.update(_queries.sketch_queries())
    out.update(_queries.stream_queries())
    out.update(_queries.synth_queries())
    return out


def oracle_sql() -> dict:
    out = {}
    out.update(_oracles.clustering_oracles())
    out.update(_oracles.nd_oracles())
    out.update(_oracles.fixed_start_oracles())
    out.update(_oracles.started_oracles())
    out.update(_oracles.report_oracles())
    out.update(_oracles.sketch_oracles())
    out.update(_oracles.stream_oracles())
    out.update(_oracles.synth_oracles())
    return out
