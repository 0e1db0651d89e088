"""Structured Streaming: envelope sources, watermarked queries and sinks, bounded replays."""
