"""Sources: literal rows, files, message topics, database tables, replayable sequences."""
