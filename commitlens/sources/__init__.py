"""Sources and sinks: commit JSON (batch and stream), text lines, file listings, CSV/console sinks."""
