"""Sources (extract readers, driver-table adapter) and sinks."""
