"""DataFrame -> DataFrame operators (merge, liftover, background fit, calling,
group test, read layer, per-base counting, report tables)."""
