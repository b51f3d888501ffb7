"""Row-wise corpus operators on a streaming DataFrame."""
