"""sluice: contract-driven curation of uploaded tabular files on Spark.

Stages (each a set-based DataFrame plan): landing inventory and hashing,
manifest events, header validation, permissive bronze load with a corrupt-row
gate, typed silver with newest-row-per-key, link tables, quality reports.
"""

from sluice.contracts import PRODUCTION_CONTRACTS, ColumnSpec, Contract

__all__ = ["PRODUCTION_CONTRACTS", "ColumnSpec", "Contract"]
