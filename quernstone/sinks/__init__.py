"""Writers: batch files with read-back, and streams drained into files."""
