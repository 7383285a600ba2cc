"""Writers for tables, manifests, statistics and reports."""
