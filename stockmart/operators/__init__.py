"""DataFrame operators: lookups, as-of joins, upserts, quality checks, archive split."""
