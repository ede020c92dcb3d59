"""modelsmith: build and maintain analytical tables on Spark.

A model is a function from DataFrames to a DataFrame. The toolkit builds it as
a view, a rebuilt table, an appended or key-upserted incremental table, or a
slowly-changing snapshot; loads typed CSV seeds; reconciles schema changes;
checks results; and supplies portable functions with pinned semantics.
"""

from modelsmith import functions
from modelsmith.operators import checks, compare, setops, stats
from modelsmith.operators.project import ModelContext, Project
from modelsmith.operators.publish import Layout
from modelsmith.operators.schema_change import SchemaChangeError
from modelsmith.sources.seeds import load_seed

__version__ = "0.1.0"

__all__ = [
    "functions", "checks", "compare", "setops", "stats", "ModelContext", "Project", "Layout",
    "SchemaChangeError", "load_seed",
]
