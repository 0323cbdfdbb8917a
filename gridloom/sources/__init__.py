"""Typed readers, derived input views, result sinks and the shared scratch area."""
