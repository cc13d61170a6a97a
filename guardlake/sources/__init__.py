"""Readers, decoders, encoders and sinks."""
