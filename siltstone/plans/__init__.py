"""Whole loads composed from the operators: raw, refined, aggregate, chain."""

from siltstone.plans.medallion import (
    AggregateSpec,
    LoadResult,
    MalformedRecords,
    RawSpec,
    RefinedSpec,
    Run,
    load_aggregate,
    load_chain,
    load_raw,
    load_refined,
)

__all__ = [
    "AggregateSpec",
    "LoadResult",
    "MalformedRecords",
    "RawSpec",
    "RefinedSpec",
    "Run",
    "load_aggregate",
    "load_chain",
    "load_raw",
    "load_refined",
]
