"""skyledger: Spark tables, joins and streams for the data work behind a radio observatory."""
