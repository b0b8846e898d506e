"""End-to-end flows from published files to published tables."""
