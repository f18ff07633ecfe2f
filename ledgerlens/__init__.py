"""ledgerlens: company-fundamentals analytics expressed as Spark DataFrame jobs.

Layers:
  functions/  Column-expression helpers (IEEE division, ladders, SIC groups, text)
  sources/    readers and writers (filings JSON, prices, tables, stand-in adapters)
  operators/  DataFrame -> DataFrame transforms (filters, concept resolution,
              derived items, valuation, as-of prices, repair/routing, features, stats)
  plans/      end-to-end jobs composed from operators (panel build, cleanup,
              analysis, model search) and the registered checks
  streaming/  incremental ingest of landed filings with Structured Streaming
"""

__version__ = "0.1.0"
