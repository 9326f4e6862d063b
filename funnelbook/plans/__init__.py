"""Windows, change detection, reload plans and the partitioned warehouse."""
