"""Streaming forms of the operators that need per-record state or timers."""
