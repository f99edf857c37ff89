"""starledger: payments lakehouse operators expressed as Spark DataFrame plans.

Layers (see README):
  sources/    landing, layer I/O, event envelopes, versioned gold store
  functions/  column-level helpers (keys, labels, exact ratios, JSON)
  operators/  conform, dedupe, quality gate, validation, merge, star joins,
              measures, time intelligence, dimension builders
  plans/      driver-table adapter, report queries, query catalog + oracle SQL
  streaming/  Structured Streaming wiring (bronze -> silver, merge runner)
"""

__version__ = "0.1.0"
