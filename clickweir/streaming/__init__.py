"""Running streams: sinks, fan-out, upserts, progress, scoring."""
