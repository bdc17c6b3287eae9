"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage.  Heavy per-text work runs in
``mapInArrow`` tasks on numpy views of the Arrow text buffer; grouping, joining
and ranking are Spark's.  Work tables are written below ``spark.checkpoint.dir``.
"""
