"""arrears: receivables risk analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or builds a Spark
ML object); compose them with ``df.transform(...)``. The sub-packages are

* ``sources``   - invoice fixture, CSV / Parquet scans and sinks, model export
* ``functions`` - column expressions (dates, buckets, min-max, decay)
* ``operators`` - cleaning, ordered pair history, scores, labels, splits,
                  profiling, evaluation and Spark ML estimators
* ``plans``     - the preprocessing, training and end-to-end jobs
* ``streaming`` - micro-batch scoring of newly arriving open invoices
"""

__version__ = "0.1.0"
