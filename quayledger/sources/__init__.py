"""Input catalog and result sinks."""
