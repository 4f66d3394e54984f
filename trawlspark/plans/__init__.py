"""End-to-end plans, derived inputs and the query catalog."""
