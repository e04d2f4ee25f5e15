"""tessera: change capture and upsert operators for multi-tenant snapshot tables, on Spark."""

from tessera.operators.merge import MergeResult, merge
from tessera.plans.specs import MergeSpec

__all__ = ["MergeResult", "MergeSpec", "merge"]
