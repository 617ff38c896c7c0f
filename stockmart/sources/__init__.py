"""Reading tables, deriving the domain tables, and writing merged facts."""
