"""Readers of raw trip and zone files, and the stored tables."""
