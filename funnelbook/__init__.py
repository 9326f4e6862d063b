"""Marketing analytics on Spark: shaping, change tracking and warehouse upkeep for all clients at once."""
