"""Files, streams of files, and versioned snapshots."""
