"""Grouped-ranking analytics on PySpark.

Every operator is a function ``DataFrame -> DataFrame`` with column names as
parameters: a *group* is a search (or order, or user), an *item* is what was
shown in it, a *gain* is the graded label.
"""

__version__ = "0.1.0"
