"""Compositions of operators, and the jobs that run them."""
