"""Sources and test-table views."""
