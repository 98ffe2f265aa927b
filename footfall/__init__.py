"""footfall — Spark-native store-visitor forecasting features and models.

Sub-packages:

* ``sources``    — schemas, CSV/parquet readers, stand-in views, sinks.
* ``functions``  — column builders (calendar, text, numeric).
* ``operators``  — DataFrame -> DataFrame operators (panel, windows, joins,
  aggregates, encoders, ordinals, folds, metrics).
* ``plans``      — composite feature pipelines and distributed model jobs
  (MLlib fits, ordered CV, Lasso path, diagnostics, recursive forecast).
* ``streaming``  — intentionally empty: the workload has no streams.
"""

__version__ = "0.1.0"
