"""Structured Streaming: intentionally empty.

The reference has no streams, watermarks, windows over time, or state, so no
streaming operator is built (see README).
"""
