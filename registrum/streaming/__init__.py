"""Streaming extension: the latest-wins merge fed by a stream."""
