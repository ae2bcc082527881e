"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when the subpackage is present.
"""
