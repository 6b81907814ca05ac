"""Structured Streaming forms of assembly and metrics.

Results equal the batch operators over the same packets, provided files land in
arrival order: order is restored inside a micro-batch, never across two.
"""
