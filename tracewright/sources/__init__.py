"""Sources, sinks and table bindings."""
