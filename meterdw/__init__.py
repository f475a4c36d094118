"""Electric-meter warehouse on PySpark: raw copies, graded detail, window summaries, serving tables."""

__version__ = "0.1.0"
