"""End-to-end job and the catalog of named queries with their SQL twins."""
