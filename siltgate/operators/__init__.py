"""DataFrame operators: validation, mapping, incremental filters, upserts, summaries."""
