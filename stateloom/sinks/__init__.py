"""Writing tables, snapshots and rows for outside consumers."""
