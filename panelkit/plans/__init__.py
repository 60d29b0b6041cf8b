"""Query plans: fixture derivations over the driver tables and the query registry."""
