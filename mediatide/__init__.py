"""Marketing analytics on Spark: landed feeds -> common data model -> marts -> reports."""

__version__ = "1.0.0"
