"""Operations of a large-scale training-data pipeline, one module per operator.

Nothing outside this package imports it; ``catalog.QUERIES`` and
``catalog.ORACLE`` hold its registered queries.
"""
