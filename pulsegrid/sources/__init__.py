"""Landing-file scans, payload flatteners and table storage."""
