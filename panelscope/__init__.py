"""Peer-based outlier analytics for retail panels, expressed as Spark DataFrame plans."""
