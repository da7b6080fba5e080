"""End-to-end plans: feature pipeline, reporting marts, registered queries and their SQL."""
