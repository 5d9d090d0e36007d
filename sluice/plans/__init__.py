"""Runs of the stages (``batch``), the local session helpers, and the
registered queries over the driver's tables (``registry`` / ``oracle``)."""

from sluice.plans.batch import (
    Store,
    current_manifest,
    get_status,
    load_upload_to_bronze,
    register_uploaded_file,
    run,
    run_links,
    run_silver,
    run_uploads,
    validate_registered_upload,
)

__all__ = [
    "Store", "current_manifest", "get_status", "load_upload_to_bronze", "register_uploaded_file", "run",
    "run_links", "run_silver", "run_uploads", "validate_registered_upload",
]
