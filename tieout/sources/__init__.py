"""Where data comes from and goes to: extracts, tables, fixture views."""
