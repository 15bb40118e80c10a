"""Operators for large-scale training-data pipelines over the document tables.

Nothing else in the package imports this subpackage; ``__spark_entry__`` adds
its queries only when it is present.
"""
