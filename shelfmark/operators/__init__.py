"""Relational operators over harvested records: merge, change report, planning, summaries."""
