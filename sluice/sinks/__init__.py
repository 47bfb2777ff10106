"""Sinks: stage, archives, quarantine, published versions."""
