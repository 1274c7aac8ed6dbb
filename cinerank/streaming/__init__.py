"""Structured Streaming: the real-time recommender and its keyed state."""
