"""Composed runs: the daily run, the registered queries and their SQL counterparts."""
