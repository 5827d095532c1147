"""stayline: clinical-style time-series extraction and cohort analytics on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, joins, aggregates and window functions.  Sessions and paths are
never created inside operators; ``stayline.session`` and ``stayline.sources``
are the only places that touch the outside world.
"""

__version__ = "0.1.0"
