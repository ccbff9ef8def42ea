"""contrail: delay and traffic analytics as plain Spark DataFrame jobs.

Sub-packages:

* ``sources``   - table scans, fixture views, dataset versions, sinks
* ``functions`` - column expressions (feature flags, calendar fields, hashes, bands)
* ``operators`` - DataFrame -> DataFrame operators (dedup, profiles, splits,
  relabelling, evaluation metrics, encoders, lineage, traffic, MLlib training)
* ``plans``     - the query catalog used by ``__spark_entry__`` and composed jobs
* ``streaming`` - Structured Streaming forms of scoring and traffic metrics
"""

from contrail.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
