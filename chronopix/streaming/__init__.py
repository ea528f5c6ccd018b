"""The same reductions over growing sources."""
