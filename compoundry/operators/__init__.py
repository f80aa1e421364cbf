"""DataFrame operators: joins, upserts, text mining, integrity checks, reports."""
