"""eventmart: trustworthy analytics from a raw, imperfect event log, on Spark."""
