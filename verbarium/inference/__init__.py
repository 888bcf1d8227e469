"""External text generation as typed operators with a pluggable provider."""
