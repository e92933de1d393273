"""Captures as they arrive: gaps between them, what is still to be looked up, streaming dedupe."""
