"""Time-series preparation, forecasting and monitoring as Spark DataFrame jobs."""

from wattlane.panel import Panel

__all__ = ["Panel"]
