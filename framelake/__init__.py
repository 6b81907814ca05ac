"""Packet-capture and recording analytics expressed as Spark DataFrame jobs."""
