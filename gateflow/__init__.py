"""gateflow: passenger-flow analytics for gate-swipe tables on PySpark."""

__version__ = "0.1.0"
