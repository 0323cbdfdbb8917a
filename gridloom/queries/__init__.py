"""Registered queries: each operator run over the supplied tables, with SQL to check it."""
