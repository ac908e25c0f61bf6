"""Streaming jobs (STR-*): the operators of ``operators`` between a stream source and a sink."""
