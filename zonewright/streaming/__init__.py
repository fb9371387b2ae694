"""Streams of keyed messages into keyed tables."""
