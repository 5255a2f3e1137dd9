"""Sources and sinks: table scans with declared schemas, CSV in/out, staging."""

from .tables import SCHEMAS, read_table
from .relevance import (attributes, attr_side_tables, pairs, product_descriptions,
                        train_pairs, test_pairs)

__all__ = ["SCHEMAS", "read_table", "pairs", "train_pairs", "test_pairs",
           "product_descriptions", "attributes", "attr_side_tables"]
