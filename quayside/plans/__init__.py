"""Plans: the daily gold run and the registered queries."""
