"""Named queries over the given tables and their plain-SQL counterparts."""
