"""Structured Streaming jobs: moderation with dead letters and result events, status view, watermarked windows."""
