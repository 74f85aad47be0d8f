"""Operators: contracts and conformance, latest-wins, quality gates, table writes,
mart building, skew tools and mart read-side queries."""
