"""Operators put together: the batch job and the served result sets."""
