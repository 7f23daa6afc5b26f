"""Session analytics on Spark.

Rolls shop click-stream events up into one leak-free feature row per session,
recovers product categories, trains and scores MLlib models, evaluates them with
exact tie-aware metrics and audits the tables.  Every operator is a
``DataFrame -> DataFrame`` function built on DataFrame / SQL / MLlib primitives.
"""

from sessionlab.constants import FEATURE_COLS  # noqa: F401

__version__ = "0.1.0"
