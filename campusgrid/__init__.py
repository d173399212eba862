"""campusgrid: cleaning, quality, snapshots and analytics for institution tables on Spark."""

__version__ = "0.1.0"
