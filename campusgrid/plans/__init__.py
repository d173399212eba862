"""Whole queries: analytics, workbook sheets, the staged run."""
