"""Composite models: cleaning chain, star schema, reports, driver queries."""
