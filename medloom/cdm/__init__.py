"""The clinical data model: tables, key columns, and a fixture."""
