"""Reading landed pages and tables, and appending to the raw layer."""
