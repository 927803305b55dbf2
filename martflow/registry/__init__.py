"""Named queries over the bundled test tables, and their SQL counterparts."""
