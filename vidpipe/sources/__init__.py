"""Sources and table snapshots."""
