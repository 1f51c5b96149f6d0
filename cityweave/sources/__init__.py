"""Where tables come from and go to: typed CSV scans, saved tables, sinks, derived test views."""
