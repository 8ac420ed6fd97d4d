"""Composed flows over the operators and the registered queries."""
