"""Queries over the generated benchmark tables: adapters to the library's schemas, and SQL oracles."""
