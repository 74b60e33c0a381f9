"""Table access: catalog of named sources, snapshot-scoped scans, driver-table stand-ins."""

from hourglass.sources.catalog import (  # noqa: F401
    ProjectSources, snapshot_scan, live_scan, stage,
)
from hourglass.sources.comparison import BINARY, CASE_BLIND, compared_params, compared_sources  # noqa: F401
from hourglass.sources.staging import Staging  # noqa: F401
