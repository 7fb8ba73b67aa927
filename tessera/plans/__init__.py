"""Composite jobs (chunk, pyramid, convert, plan, shade) built from the operators."""
