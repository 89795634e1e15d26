"""Waves of captures as a stream."""
