"""From the raw logs to staging, intermediate tables, the star and its profiles."""
