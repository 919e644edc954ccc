"""quillstream: word counts over message streams, with an offset ledger and a
versioned cell table, written as plain PySpark DataFrame / SQL / Structured
Streaming jobs.

Layout:
  functions/  column expressions (tokeniser, line framing, ledger codec)
  sources/    readers: driver tables, topic logs, line sources
  operators/  DataFrame -> DataFrame transforms (counts, offsets, cells, ...)
  sinks/      idempotent table writers (ledger, cells, counts)
  streaming/  Structured Streaming wiring (replay source, foreachBatch)
  plans/      the registered queries and their DuckDB oracle SQL
"""

from quillstream.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
