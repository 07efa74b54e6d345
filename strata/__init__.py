"""strata: layered (Bronze / Silver / Gold) analytics pipelines on Spark.

Operators are ``DataFrame -> DataFrame`` functions (``strata.operators``,
``strata.functions``), readers and writers live in ``strata.sources`` and
``strata.sinks``, streaming flows in ``strata.streaming`` and the query keys of
``__spark_entry__.py`` in ``strata.plans``.
"""

__version__ = "0.1.0"
