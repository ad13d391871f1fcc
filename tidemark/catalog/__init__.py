"""Registered queries: the library run over the given tables, each with its SQL counterpart."""
