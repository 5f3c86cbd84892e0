"""The preparation step over arriving files."""
