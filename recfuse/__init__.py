"""recfuse: record linkage and data fusion as PySpark dataflows."""

__version__ = "0.1.0"
