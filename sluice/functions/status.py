"""Upload status values and which stage may move which status.

Statuses are plain strings in the manifest; these are the fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ten upload statuses.
RECEIVED = "RECEIVED"
DUPLICATE = "DUPLICATE"
VALIDATING = "VALIDATING"
VALIDATED = "VALIDATED"
REJECTED = "REJECTED"
FAILED = "FAILED"
PROCESSING = "PROCESSING"
PROCESSED = "PROCESSED"
BRONZE_REJECTED = "BRONZE_REJECTED"
BRONZE_FAILED = "BRONZE_FAILED"

ALL_STATUSES = (
    RECEIVED, DUPLICATE, VALIDATING, VALIDATED, REJECTED,
    FAILED, PROCESSING, PROCESSED, BRONZE_REJECTED, BRONZE_FAILED,
)

# Claim rules. A stage may also re-claim its own working
# status once that claim is stale.
CLAIMABLE_FOR_VALIDATION = (RECEIVED, FAILED)
CLAIMABLE_FOR_BRONZE = (VALIDATED, BRONZE_FAILED)
TERMINAL_STATUSES = (DUPLICATE, REJECTED, BRONZE_REJECTED, PROCESSED)
WORKING_STATUSES = (VALIDATING, PROCESSING)

# Working status -> status a stale claim is released to.
STALE_RELEASE = {VALIDATING: FAILED, PROCESSING: BRONZE_FAILED}
STALE_CLAIM_MINUTES = 30
STALE_MESSAGE = "Interrupted before completion."


def is_terminal(status: Column | str) -> Column:
    c = F.col(status) if isinstance(status, str) else status
    return c.isin(*TERMINAL_STATUSES)
