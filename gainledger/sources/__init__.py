"""Source tables, upload lists and job rows."""
