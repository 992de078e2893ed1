"""Message streams: landing, retry routing, log compaction, query audit."""
