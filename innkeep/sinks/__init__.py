"""Writers: replace, append, staged publish, daily snapshots, text export."""
