"""Operators of a training-data pipeline. Nothing else in the library imports them.

``QUERIES`` and ``ORACLES`` are in ``gridtally.llm.queries``.
"""
