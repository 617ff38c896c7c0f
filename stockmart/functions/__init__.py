"""Column expressions: status classification, measures, KPIs, scalar helpers."""
