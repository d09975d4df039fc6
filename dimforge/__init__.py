"""dimforge: conformed dimension and fact tables on Spark DataFrames.

Layers:
  functions  native Column expressions (keys, codes, labels, dates, masks)
  operators  DataFrame operators (stage, lookup joins, origin registry,
             aligned union + distinct, grouped sums)
  sources    catalog / Parquet access, snapshots, publishing
  plans      the conformed builds (field, site, variety, planning)
"""

__version__ = "0.1.0"
