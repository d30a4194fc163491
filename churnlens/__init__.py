"""churnlens: user-activity and churn analytics as Spark DataFrame operators.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and leaves the
physical plan to Catalyst/AQE.  Only feature-sized or report-sized results
(coefficients, a top-25 list, a handful of metrics) ever reach the driver.
"""

from churnlens.config import ChurnSpec, DEFAULT_SPEC
from churnlens.session import get_session, checkpoint_dir

__all__ = ["ChurnSpec", "DEFAULT_SPEC", "get_session", "checkpoint_dir"]
