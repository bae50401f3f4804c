"""Column functions: parsing, scoring, geography and repeatable hashing."""
