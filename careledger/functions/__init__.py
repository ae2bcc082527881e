"""Column helpers (F1-F18) and window predicates.

Each helper returns a ``Column`` built from ``pyspark.sql.functions``
built-ins, so every expression stays inside whole-stage codegen and filters
stay visible to Catalyst for pushdown.
"""

from careledger.functions.columns import *  # noqa: F401,F403
from careledger.functions.predicates import *  # noqa: F401,F403
