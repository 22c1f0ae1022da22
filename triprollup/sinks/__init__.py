"""Where messages and tables are written to."""
