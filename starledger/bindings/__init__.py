"""Binding of the engine to the TPC-H-like test tables, and the registered queries."""
