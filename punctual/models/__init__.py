"""Delay regression with MLlib."""
