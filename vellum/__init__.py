"""vellum — Spark-native API-to-table analytics.

Turns API responses, nested specifications, web pages and positioned text
into relational tables and answers questions over them, written entirely as
DataFrame / Spark SQL plans:

* ``sources``    — table loading, spec/event scans, landed-response reshapes
* ``functions``  — column-level helpers (JSON, ids, prices, text shapes)
* ``operators``  — table-level operators (temporal history, shredding,
                   pricing, domains, fingerprints, sieve, embeddings)
* ``plans``      — the registered queries over the driver tables
* ``streaming``  — Structured Streaming feeds into temporal history
"""

from vellum.session import get_spark  # noqa: F401

__all__ = ["get_spark"]
