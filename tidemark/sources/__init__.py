"""Reading and writing: partitioned lakes, snapshots, payloads and reference files."""
