"""Structured Streaming forms of the operators: watermarks, windowed
aggregation, chained top-N, stream-stream joins and ``transformWithState``
processors, plus replay helpers for bounded inputs."""
