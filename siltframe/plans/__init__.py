"""What a user asks an archive for: snapshots and summaries."""
