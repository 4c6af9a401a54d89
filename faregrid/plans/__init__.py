"""Plans: composite jobs over the lake, metrics, and the registered queries."""
