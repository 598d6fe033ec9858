"""All registered checks."""

from __future__ import annotations

from almacen.checks import block_checks, cleaning_checks, report_checks, star_checks  # noqa: F401
from almacen.checks.registry import CHECKS

__all__ = ["CHECKS"]
