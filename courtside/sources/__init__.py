"""Sources and sinks: test tables, landing JSON, seeds, versioned tables."""
