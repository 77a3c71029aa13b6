"""Where data comes from: XML directories, message topics and logs, relational tables."""
