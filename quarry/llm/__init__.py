"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds
``queries.QUERIES`` and ``queries.ORACLES`` only where it is present.
"""
