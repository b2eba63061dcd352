"""Raw-file scans and table storage."""
