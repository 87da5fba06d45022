"""Reports and jobs composed from sources, operators and sinks."""
