"""DataFrame → DataFrame operators with column names and limits as arguments."""
