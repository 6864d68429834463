"""Operators for large-scale training-data pipelines.

One module per operator, their registered queries in ``queries`` and the
stages of the corpus pipeline in ``stages``. Nothing else in the library
imports this subpackage."""
