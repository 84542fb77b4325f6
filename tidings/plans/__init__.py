"""Named queries and the SQL they must agree with."""
