"""Query plans bound to the supplied tables: the commit testbed view, the log view, and the query registry."""
