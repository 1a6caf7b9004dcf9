"""Plan helpers: lineage cuts, ordered-gap plans, input views and the query list."""
