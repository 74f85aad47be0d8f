"""Plans: end-to-end jobs (gold mart, slice runner), the registered queries and the bench."""
