"""DataFrame operators: change statements, row picking, joins behind a size check."""
