"""Operators on DataFrames: links, frontiers, chunks, outcomes, pacing."""
