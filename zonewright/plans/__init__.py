"""The three zone flows, written with the operators."""
