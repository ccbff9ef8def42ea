"""All registered queries; importing the catalog modules fills the registry."""

from __future__ import annotations

from contrail.plans import (  # noqa: F401
    catalog_boosting, catalog_features, catalog_io, catalog_models, catalog_profiles, catalog_streaming,
    catalog_traffic,
)
from contrail.plans.registry import REGISTRY

FLAGSHIP = "severity_positive_share"


def queries():
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
