"""emporia: retail order analytics as Spark DataFrame jobs.

Layers, each a set of pure ``DataFrame -> DataFrame`` functions:

* ``emporia.sources``   - dataset registry, CSV ingest with explicit schemas,
  layer tables (read / overwrite), and the stand-in views over the test tables.
* ``emporia.functions`` - column-level scalar helpers (text cleaning, safe casts,
  wall-clock timestamps, delivery days, zip keys, line totals).
* ``emporia.operators`` - relational building blocks (repeatable key dedupe,
  geo centroids, exact sums, DataFrame profiling, and joins that AQE can split).
* ``emporia.plans``     - the bronze / silver / gold table jobs and their DAG.

I/O happens only at the edges (``sources`` and ``plans.jobs``); the caller owns
the SparkSession.
"""

__version__ = "0.1.0"
