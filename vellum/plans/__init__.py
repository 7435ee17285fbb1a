"""Registered queries over the driver tables (see ``registry``)."""

from vellum.plans import q_collections, q_discovery, q_domains, q_embed, q_json, q_pricing, q_profile, q_regions, q_registry, q_requests, q_sieve, q_sinks, q_sql, q_temporal  # noqa: F401
from vellum.plans.registry import FAMILY, ORACLE, QUERIES  # noqa: F401
