"""End-to-end questions, fixtures over the driver's tables, and the query registry."""
