"""End-to-end runs composed of sources, operators and sinks."""
