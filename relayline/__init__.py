"""relayline: offline-conversion reporting as distributed DataFrame jobs.

Sub-packages:
  sources    test tables derived from the driver data; snapshot table store
  functions  column expressions (PII normalisation, time formats)
  operators  eligibility, routing, payloads, envelopes, control upsert,
             responses, reconciliation, quality audits
  plans      named queries and their DuckDB oracle SQL
  streaming  micro-batch delivery of send outcomes into the control table
"""

__version__ = "0.1.0"
