"""Writers of reports."""
