"""Sources and sinks: message codecs, payload flattening, scans, article selection."""
