"""Column-level building blocks: rounding, text, dates, mergeable measures."""
