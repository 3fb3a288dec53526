"""sessionlens: product analytics over nested web-event exports, on Spark.

Every public function takes and returns a ``pyspark.sql.DataFrame``; the
logical plan is declared with the DataFrame API and executed by Catalyst.
"""

from sessionlens.config import Params

__all__ = ["Params"]
