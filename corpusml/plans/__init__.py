"""Plans: end-to-end jobs and the registered queries over the driver tables."""
