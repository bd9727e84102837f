"""pactlens: PySpark analytics for vehicle-service-contract portfolios."""

from pactlens.config import ReportConfig

__all__ = ["ReportConfig"]
