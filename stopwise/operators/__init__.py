"""DataFrame operators: as-of joins, shaping, schedules, enrichment, paths."""
