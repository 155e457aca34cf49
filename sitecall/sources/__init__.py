"""File readers (S1-S14) and sinks (K1-K6)."""
