"""bazaar: marketplace analytics marts on Spark DataFrames.

Layout:
  functions/  Column helpers (scaling, ratios, JSON, ids, casts)
  operators/  DataFrame operators (pivot, funnel, dedupe, sequence, as-of, lookups)
  sources/    table access, config table, derived inputs, sinks
  plans/      the marts, the registered queries and their SQL twins
  streaming/  incremental day-partition runner
  run.py      command line: one mart over catalog tables or paths
"""

__version__ = "0.1.0"
