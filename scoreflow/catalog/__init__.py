"""The registered queries, their SQL and the feeds they read."""
