"""Readers and parsers for the inputs of the fleet."""
