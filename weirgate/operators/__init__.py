"""Record shaping, joins, windows, incremental bounds and audits."""
