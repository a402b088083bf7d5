"""orderstar — a sales star-schema and customer-feature library on Spark DataFrames.

Layers:

* ``orderstar.sources``   — raw CSV / parquet readers, audit columns, writers, fixture adapter.
* ``orderstar.functions`` — column expressions (casts, keys, calendar attributes, ratios).
* ``orderstar.operators`` — DataFrame -> DataFrame operators (standardise, dedupe, dimensions,
  facts, features, upsert, data quality).
* ``orderstar.plans``     — composite jobs (the bronze -> silver -> gold run), registered queries and
  their SQL oracles.

Every operator takes its clock (``as_of`` / ``now``), calendar range and keys as arguments and sets no
session configuration.
"""

__version__ = "0.1.0"
