"""stratus: weather-observation ingestion, validation and reporting on Spark.

Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function
built on ``pyspark.sql.functions``; nothing is collected to the driver except
one-row reports and bounded samples.
"""

from stratus.session import get_session, shared_dir  # noqa: F401

__all__ = ["get_session", "shared_dir"]
