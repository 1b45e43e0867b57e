"""Named queries (Spark builders + oracle SQL) and read-side plans."""
