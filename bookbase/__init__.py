"""Book catalogues as Spark tables: extraction, cleaning, vector search, lookups and prompts."""
