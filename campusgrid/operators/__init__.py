"""DataFrame operators: cleaning, quality, joins, snapshots."""
