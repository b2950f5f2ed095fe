"""Ordered operator lists with checkpoints, and the registered queries."""
