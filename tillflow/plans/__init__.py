"""How the operators are put together: the table graph, the daily run, the registered queries."""
