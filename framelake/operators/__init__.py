"""Table-level operators: numbering, assembly, flows, joins, metrics."""
