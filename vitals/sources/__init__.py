"""Sources, sinks and tables."""
